"""License scans by template markup.

A template is wording with optional regions, ``<<beginOptional>> ...
<<endOptional>>``, and replaceable ones, ``<<var;max=N>>`` (any 0 to N words).
Templates and the plain phrases compile into one automaton over words: a state
per place between words, empty moves around optional regions, and a chain of
any-word moves for a replaceable one.  A text is accepted at every place where
a template's mandatory wording stands exactly, in order and without other
words between.

Per document the automaton runs only if the text holds some template's anchor
(its longest mandatory word); without it no template can match, so whole
texts are searched and nothing is lost.  Rows are independent: no shuffle.

Defined results: a null text counts as empty (no words, no labels, score 0);
repeated rows are scanned each; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.llm.common import ship_by_value, small_batches, text_or_empty

# Plain phrases and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# License notices and texts as template markup: (label, wording).  Mandatory wording stands in full; regions vary only
# where the published texts do (names of works and holders, numbers of clauses, the third clause, an option).
TEMPLATES = [
    ("gpl-notice", "<<beginOptional>>this work is<<endOptional>> licensed under the gnu general public license "
                   "<<beginOptional>>as published by the free software foundation<<endOptional>> "
                   "<<beginOptional>>either<<endOptional>> version <<var;max=1>> "
                   "<<beginOptional>>or any later version<<endOptional>>"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("cc-by-nc-4.0", "licensed under <<beginOptional>>a creative commons<<endOptional>> cc by nc 4 0"),
    ("cc-by-4.0", "licensed under <<beginOptional>>a creative commons<<endOptional>> cc by 4 0"),
    ("mit-notice", "released under the <<var;max=2>> mit license"),
    ("gpl-header", "this <<var;max=4>> is free software you can redistribute it and or modify it under the terms of the "
                   "gnu general public license as published by the free software foundation either version <<var;max=1>> "
                   "of the license <<beginOptional>>or <<beginOptional>>at your option<<endOptional>> any later version<<endOptional>> "
                   "<<beginOptional>>this <<var;max=4>> is distributed in the hope that it will be useful but without any "
                   "warranty without even the implied warranty of merchantability or fitness for a particular purpose "
                   "see the gnu general public license for more details<<endOptional>>"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this <<var;max=4>> and "
                 "associated documentation files <<beginOptional>>the <<var;max=2>><<endOptional>> to deal in the <<var;max=2>> "
                 "without restriction including without limitation the rights to use copy modify merge publish distribute "
                 "sublicense and or sell copies of the <<var;max=2>> and to permit persons to whom the <<var;max=2>> is furnished "
                 "to do so subject to the following conditions the above copyright notice and this permission notice "
                 "<<beginOptional>>including the next paragraph<<endOptional>> shall be included in all copies or substantial "
                 "portions of the <<var;max=2>> the <<var;max=2>> is provided as is without warranty of any kind express or implied "
                 "including but not limited to the warranties of merchantability fitness for a particular purpose and "
                 "<<beginOptional>>non infringement<<endOptional>><<beginOptional>>noninfringement<<endOptional>> in no event shall "
                 "<<var;max=16>> be liable for any claim damages or other liability whether in an action of contract tort or "
                 "otherwise arising from out of or in connection with the <<var;max=2>> or the use or other dealings in the "
                 "<<var;max=2>>"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted provided that "
                 "the following conditions are met <<beginOptional>>1<<endOptional>> redistributions of source code must retain the "
                 "above copyright notice this list of conditions and the following disclaimer <<beginOptional>>2<<endOptional>> "
                 "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
                 "following disclaimer in the documentation and or other materials provided with the distribution "
                 "<<beginOptional>><<beginOptional>>3<<endOptional>> neither the name of <<var;max=12>> nor the names of "
                 "<<var;max=4>> contributors may be used to endorse or promote products derived from this software without specific "
                 "prior written permission<<endOptional>> this software is provided by <<var;max=12>> as is and any express or "
                 "implied warranties including but not limited to the implied warranties of merchantability and fitness for a "
                 "particular purpose are disclaimed in no event shall <<var;max=16>> be liable for any direct indirect incidental "
                 "special exemplary or consequential damages including but not limited to procurement of substitute goods or "
                 "services loss of use data or profits or business interruption however caused and on any theory of liability "
                 "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use "
                 "of this software even if advised of the possibility of such damage"),
]

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")      # words of a text whose A-Z are lower-cased, as UTF-8 bytes
MARKUP = re.compile(r"<<beginOptional>>|<<endOptional>>|<<var;max=(\d+)>>")

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, matches array<struct<label:string,first:long,past:long>>")


def lower_words(text: str | None) -> bytes:
    return (text or "").encode("utf-8").lower()


class Automaton:
    """All templates as one automaton over words."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.moves: list[dict[bytes, list[int]]] = []     # by state: word -> states
        self.any_word: list[list[int]] = []               # by state: states after any word
        self.empty: list[list[int]] = []                  # by state: states without a word
        self.accepts: dict[int, str] = {}
        self.starts: list[int] = []
        anchors = set()
        for label, wording in templates:
            words = self._compile(label, wording)
            if not words:
                raise ValueError(f"template {label} has no mandatory word")
            anchors.add(max(words, key=len))
        self.closed = [self._closure(s) for s in range(len(self.moves))]
        self.begin = sorted({x for s in self.starts for x in self.closed[s]})
        self.begin_words = {w for s in self.begin for w in self.moves[s]}
        if any(self.any_word[s] for s in self.begin):
            raise ValueError("a template must not begin with a replaceable region")
        self.anchors = re.compile(b"|".join(re.escape(a) for a in sorted(anchors)))

    def _state(self) -> int:
        self.moves.append({})
        self.any_word.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def _words(self, state: int, text: str) -> tuple[int, list[bytes]]:
        words = WORDS.findall(lower_words(text))
        for w in words:
            after = self._state()
            self.moves[state].setdefault(w, []).append(after)
            state = after
        return state, words

    def _compile(self, label: str, wording: str) -> list[bytes]:
        state, at, opened, mandatory = self._state(), 0, [], []
        self.starts.append(state)
        for m in [*MARKUP.finditer(wording), None]:
            state, words = self._words(state, wording[at:m.start() if m else len(wording)])
            mandatory += [] if opened else words
            if m is None:
                break
            at = m.end()
            if m[1] is not None:
                end = self._state()
                for _ in range(int(m[1])):
                    self.empty[state].append(end)
                    after = self._state()
                    self.any_word[state].append(after)
                    state = after
                self.empty[state].append(end)
                state = end
            elif m[0] == "<<beginOptional>>":
                opened.append(state)
            else:
                end = self._state()
                self.empty[state].append(end)
                self.empty[opened.pop()].append(end)
                state = end
        if opened:
            raise ValueError(f"template {label}: an optional region is not closed")
        self.accepts[state] = label
        return mandatory

    def _closure(self, state: int) -> list[int]:
        seen, todo = {state}, [state]
        while todo:
            for x in self.empty[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return sorted(seen)

    def matches(self, words: list[bytes]) -> list[tuple[str, int, int]]:
        """(label, first word, word past the last) of each template at each place, longest reading only."""
        found: dict[tuple[str, int], int] = {}
        for first, word in enumerate(words):
            if word not in self.begin_words:
                continue
            states, i = self.begin, first
            while states:
                for s in states:
                    if s in self.accepts:
                        found[self.accepts[s], first] = i
                if i == len(words):
                    break
                after = {x for s in states for y in (*self.moves[s].get(words[i], ()), *self.any_word[s])
                         for x in self.closed[y]}
                states, i = sorted(after), i + 1
        return sorted((label, first, past) for (label, first), past in found.items())


def scan_text(low: bytes, phrases: Automaton, templates: Automaton) -> dict:
    """Counts, places and labels of one lower-cased text."""
    words = WORDS.findall(low)
    base = phrases.matches(words) if phrases.anchors.search(low) else []
    more = templates.matches(words) if templates.anchors.search(low) else []
    places = [first for _, first, _ in base]
    base_labels = {label for label, _, _ in base}
    return {
        "n_words": len(words), "n_base": len(base),
        "first_word": min(places, default=None), "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | {label for label, _, _ in more})),
        "score": 1.0 if more else 0.5 if base else 0.0,
        "matches": [{"label": a, "first": b, "past": c} for a, b, c in base + more],
    }


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None,
                  phrases: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: word count, phrase places, labels of phrases and templates, all matches with their spans.

    ``score`` is 1 where a whole notice is accepted, 0.5 where only a phrase
    stands, else 0.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    kinds = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                       ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                       ("labels", pa.string()), ("score", pa.float64()),
                       ("matches", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()),
                                                       ("past", pa.int64())])))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, marked = Automaton([(label, words) for words, label in phrases.items()]), Automaton(templates)
        for batch in batches:
            rows = [scan_text(lower_words(t.as_py()), plain, marked) for t in batch.column(1)]
            ids = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_pylist([{"doc_id": i, **r} for i, r in zip(ids, rows)], schema=kinds)

    return small_batches(docs).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")) \
        .mapInArrow(scan, SCHEMA)


ship_by_value(__name__)
