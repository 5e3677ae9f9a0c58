"""Byte-level BPE encoding and decoding through a minimal automaton of frequent words.

1. Count.  Texts are cut into words (a run of non-white characters with at
   most one blank before it, or a run of white space); no token of the
   tokenizer's pattern crosses such a cut.  Words are counted over the whole
   corpus, and the ``LEXICON_WORDS`` most frequent are kept.
2. Compile.  The frequent words and their ids become a minimal acyclic
   transducer: words share prefixes and suffixes, and the number of words
   that sort before a word (summed along its path) is the place of its ids
   in one pool.  It is stored as one flat file and sent to every node.
3. Encode.  Tasks memory-map the file and walk it for many words at a time.
   A word the automaton does not hold is cut by the tokenizer's pattern, and
   the pieces of many words at a time are merged exactly by the tokenizer's own
   merge table (the library's BPE model).  A worker keeps its encoder from task
   to task.  Decoding concatenates the ids' bytes.

Texts are cut into words on whole arrays of bytes; texts with a special token
or with white space outside ASCII are cut by the pattern.

Special tokens in a text get their own id, as the tokenizer's library does by
default.  Words are counted by bounded steps of text.  The automaton has a fixed number of words, so neither
the driver's share nor what a task remembers grows with the input.

Defined results: a null text counts as empty (no ids); an empty table gives an
empty result; repeated rows are encoded each; extra columns are ignored (or
carried along by ``with_tokens``).
"""

from __future__ import annotations

import hashlib
import mmap
import os
import re
import struct
import tempfile
import uuid
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealsieve.llm.common import (from_worker, materialise, ship_by_value, small_batches, text_or_empty,
                                  to_worker)

LEXICON_WORDS = 1 << 19     # words in the automaton, at most
STEP_BYTES = 2 << 20        # text bytes encoded at once
COUNTER_WORDS = 1 << 16     # counted words that a counting task passes on at once
ROW_WORDS = 1 << 16         # words of the automaton that an encoder of whole rows keeps between steps
JOINED_WORDS = 500          # words that the library encodes as one text
JOINED_TEXTS = 64           # such texts at once
KNOWN_PIECES = 1 << 14      # pieces of words outside the automaton whose ids are remembered

# The tokenizer's cut into pieces (fixed value), and our coarser cut at white space.
PIECES = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_W = "\\x09-\\x0d\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORDS = re.compile(f" ?[^{_W}]+|[{_W}]+(?![^{_W}])|[{_W}]+")
WIDE_WHITE = "[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
IS_WHITE = np.zeros(256, bool)      # by byte, for texts without white space outside ASCII
IS_WHITE[[*range(9, 14), 32]] = True


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every span, one after the other."""
    past = np.cumsum(lengths)
    return np.repeat(starts - (past - lengths), lengths) + np.arange(int(past[-1]) if len(past) else 0)


class Tokenizer:
    """A byte-level BPE tokenizer file: its merge table, its ids' bytes and its special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Library
        from tokenizers.pre_tokenizers import WhitespaceSplit
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library = Library.from_file(path)
        self.model = library.model
        self.pieces = Library(library.model)        # the merges alone
        self.pieces.pre_tokenizer = WhitespaceSplit()
        # Printable stand-ins of the 256 bytes: themselves where printable, else the next code points from 256.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        self.stand_in = [c for c, _ in sorted(byte_of.items(), key=lambda x: x[1])]
        self.special = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
        vocabulary = library.get_vocab(with_added_tokens=False)
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocabulary.items()}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.width = np.zeros(max(self.bytes_of) + 1, np.int64)     # bytes of each id
        self.width[list(self.bytes_of)] = [*map(len, self.bytes_of.values())]
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                         + ")") if self.special else None
        self.odd = "|".join([WIDE_WHITE, *map(re.escape, self.special)])
        self.merge = lru_cache(maxsize=KNOWN_PIECES)(self._merge)       # full stops and the like come often

    def _merge(self, piece: str) -> list[int]:
        """Ids of one piece of the pattern."""
        if piece.isascii() and piece.isprintable():
            shown = piece.replace(" ", self.stand_in[32])
        else:
            shown = "".join([self.stand_in[b] for b in piece.encode("utf-8")])
        return [t.id for t in self.model.tokenize(shown)]

    def encode_word(self, word: str) -> list[int]:
        if word.lstrip(" ").isalpha():      # one run of letters, at most one blank before it: one piece
            return self._merge(word)
        return [i for piece in PIECES.findall(word) for i in self.merge(piece)]

    def _shown(self, word: bytes) -> str:
        """The word's pieces in the stand-ins of their bytes, with blanks between them (no stand-in is one)."""
        text = word.decode("utf-8")
        pieces = [text] if text.lstrip(" ").isalpha() else PIECES.findall(text)
        if text.isascii() and text.isprintable():
            return " ".join([p.replace(" ", self.stand_in[32]) for p in pieces])
        return " ".join(["".join([self.stand_in[b] for b in p.encode("utf-8")]) for p in pieces])

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, each word's number of ids) of words without a special token, many at a time.

        The pieces go to the library's model; the bytes of the ids tell where each word ends.
        """
        ids, sizes = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for at in range(0, len(words), JOINED_WORDS * JOINED_TEXTS):
            some = words[at:at + JOINED_WORDS * JOINED_TEXTS]
            shown = [*map(self._shown, some)]
            texts = [" ".join(shown[i:i + JOINED_WORDS]) for i in range(0, len(shown), JOINED_WORDS)]
            own = np.concatenate([np.array(e.ids, np.int32) for e in
                                  self.pieces.encode_batch_fast(texts, add_special_tokens=False)])
            ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
            sizes.append(np.diff(np.searchsorted(np.cumsum(self.width[own]), ends) + 1, prepend=0))
            ids.append(own)
        return np.concatenate(ids), np.concatenate(sizes)

    def cut_arrays(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts as one array of bytes, and each text's number of words."""
        column = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(column, self.odd).to_numpy(zero_copy_only=False).astype(bool) \
            if len(texts) else np.empty(0, bool)
        plain = column.filter(pa.array(~odd)) if odd.any() else column
        ends = np.frombuffer(plain.buffers()[1], np.int64, len(plain) + 1, plain.offset * 8) if len(plain) \
            else np.zeros(1, np.int64)
        data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]] if len(plain) \
            else np.empty(0, np.uint8)
        ends = ends - ends[0]
        white = IS_WHITE[data]
        first = np.zeros(len(data) + 1, bool)       # begins a text
        first[ends] = True
        # A word begins where a text does, where white space does, at the last of some white space before other
        # characters, and at these unless a blank stands before them.
        begins = first[:-1].copy()
        begins[1:] |= white[1:] & ~white[:-1]
        begins[:-1] |= white[:-1] & ~white[1:] & ~first[1:-1]
        begins[1:] |= ~white[1:] & white[:-1] & (data[:-1] != 32)
        starts = np.flatnonzero(begins)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        number = np.zeros(len(texts), np.int64)
        number[~odd] = np.diff(np.searchsorted(starts, ends))
        if not odd.any():
            return words, number
        cut = [self.cut(texts[k]) for k in np.flatnonzero(odd).tolist()]
        number[odd] = [*map(len, cut)]
        both = pa.chunked_array([words, pa.array([w.encode() for w in chain.from_iterable(cut)], pa.large_binary())]) \
            .combine_chunks()
        at = np.empty(len(texts), np.int64)         # a text's first word among those cut here, then those by pattern
        order = np.concatenate((np.flatnonzero(~odd), np.flatnonzero(odd)))
        at[order] = np.cumsum(number[order]) - number[order]
        return both.take(pa.array(spans(at, number))), number

    def cut(self, text: str) -> list[str]:
        """Words and special tokens of a text, in order; together they are the text."""
        if self.special_cut is None or not any(s in text for s in self.special):
            return WORDS.findall(text)
        return [w for part in self.special_cut.split(text)
                for w in ([part] if part in self.special else WORDS.findall(part))]

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", errors="replace")


# ---------------------------------------------------------------- the automaton

HEADER = "<8sIIII"      # magic, states, moves, words, ids
MAGIC = b"LEXIDS01"


def compile_lexicon(words: Iterable[tuple[bytes, Iterable[int]]]) -> bytes:
    """A minimal acyclic automaton of sorted words, with their ids in the same order, as one flat file.

    When the path of the last word can no longer change, its states are
    replaced by equal ones already registered, so equal endings are stored
    once.
    """
    register: dict[bytes, int] = {}
    done: list[bytes] = []                  # each state packed: final flag, then its moves (byte, state)
    path: list[list] = [[0, []]]            # open states of the last word: final, moves
    ids, starts = array("I"), array("I", [0])

    def freeze(state: list) -> int:
        key = bytes([state[0]]) + b"".join([struct.pack("<BI", b, t) for b, t in state[1]])
        if key not in register:
            register[key] = len(done)
            done.append(key)
        return register[key]

    def close(length: int) -> None:
        while len(path) > length + 1:
            number = freeze(path.pop())
            path[-1][1][-1] = (path[-1][1][-1][0], number)

    last = None
    for word, own in words:
        if last is not None and word <= last:
            raise ValueError("words must be sorted and different")
        same = len(os.path.commonprefix([last or b"", word]))
        close(same)
        for b in word[same:]:
            path[-1][1].append((b, -1))
            path.append([0, []])
        path[-1][0] = 1
        last = word
        ids.extend(own)
        starts.append(len(ids))
    close(0)
    root = freeze(path[0])

    below = array("I")      # words that can be read from a state; states come after the states they reach
    keys, targets, skips = array("I"), array("I"), array("I")
    for number, state in enumerate(done):
        earlier = state[0]
        for b, t in struct.iter_unpack("<BI", state[1:]):
            keys.append(number << 8 | b)
            targets.append(t)
            skips.append(earlier)
            earlier += below[t]
        below.append(earlier)
    finals = bytes(state[0] for state in done)
    return b"".join([struct.pack(HEADER, MAGIC, len(done), len(keys), len(starts) - 1, len(ids)),
                     struct.pack("<I", root), *(x.tobytes() for x in (keys, targets, skips, starts, ids)), finals])


class Lexicon:
    """Reads a compiled lexicon in place, from a memory map or any bytes.

    A move is the number (state * 256 + byte); the moves are stored sorted.
    """

    def __init__(self, data):
        magic, states, moves, words, ids = struct.unpack_from(HEADER, data, 0)
        if magic != MAGIC:
            raise ValueError("not a lexicon file")
        at = struct.calcsize(HEADER)

        def numbers(kind, n):
            nonlocal at
            part = np.frombuffer(data, kind, n, at)
            at += part.nbytes
            return part
        self.root = int(numbers(np.uint32, 1)[0])
        self.keys, self.targets, self.skips = (numbers(np.uint32, moves) for _ in range(3))
        self.starts, self.ids = numbers(np.uint32, words + 1), numbers(np.uint32, ids)
        self.finals = numbers(np.uint8, states)

    @classmethod
    def map_file(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def places(self, words: list[bytes]) -> np.ndarray:
        """Each word's number in sorted order, or -1 if the automaton does not accept it."""
        text = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(sizes) - sizes
        state, place = np.full(len(words), self.root, np.uint32), np.zeros(len(words), np.int64)
        walking, step = np.flatnonzero(sizes > 0) if len(self.keys) else np.empty(0, np.int64), 0
        alive = np.ones(len(words), bool) if len(self.keys) else sizes == 0
        while len(walking):
            key = state[walking] << np.uint32(8) | text[begin[walking] + step]
            move = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[move] == key
            alive[walking[~found]] = False
            walking, move = walking[found], move[found]
            place[walking] += self.skips[move]
            state[walking] = self.targets[move]
            step += 1
            walking = walking[sizes[walking] > step]
        return np.where(alive & (self.finals[state] > 0), place, -1)

    def get(self, word: bytes) -> list[int] | None:
        """The word's ids, or None if the automaton does not accept it."""
        place = int(self.places([word])[0])
        return None if place < 0 else self.ids[self.starts[place]:self.starts[place + 1]].tolist()


# ---------------------------------------------------------------- Spark jobs

def frequent_words(docs: DataFrame, tokenizer_path: str, text_col: str = "text",
                   limit: int = LEXICON_WORDS) -> list[str]:
    """The words above the smallest count that at most ``limit`` words reach, over all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = from_worker("byte-tokenizer", tokenizer_path) or Tokenizer(tokenizer_path)
        for batch in batches:
            for _, texts in steps(batch, 0):
                words, _ = tokenizer.cut_arrays(texts)
                counts = words.value_counts()       # Spark's partial aggregate adds up the counts of a task
                for at in range(0, len(counts), COUNTER_WORDS):
                    some = counts.slice(at, COUNTER_WORDS)
                    yield pa.RecordBatch.from_arrays([some.field("values").cast(pa.string()), some.field("counts")],
                                                     names=["word", "n"])
        to_worker("byte-tokenizer", tokenizer_path, tokenizer)

    counted = materialise(small_batches(docs).select(text_or_empty(text_col).alias("text")).mapInArrow(count, "word string, n long")
                          .groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"), "word-counts")
    # Words per bin of counts (at most 64 bins to a doubling); whole bins are taken from the top while they fit.
    bin_of = F.floor(F.log2("n") * 64).cast("int")
    held, lowest = 0, None
    for r in counted.groupBy(bin_of.alias("b")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("b")).collect():
        held += r.words
        if held > limit:
            break
        lowest = r.b
    if lowest is None:
        return []
    return sorted(counted.where(bin_of >= lowest).select("word").toArrow().column(0).to_pylist())


def publish_lexicon(docs: DataFrame, tokenizer_path: str, text_col: str = "text",
                    limit: int = LEXICON_WORDS) -> str:
    """Count, compile and send the lexicon to every node; returns the name to ask Spark's files for."""
    tokenizer = Tokenizer(tokenizer_path)
    words = frequent_words(docs, tokenizer_path, text_col, limit)
    words = [w.encode("utf-8") for w in words if w not in tokenizer.special]
    ids, sizes = tokenizer.encode_words(words)
    ends = np.cumsum(sizes).tolist()
    data = compile_lexicon((w, ids[end - n:end].tolist()) for w, end, n in zip(words, ends, sizes.tolist()))
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), f"lexicon-{uuid.uuid4().hex}.bin")
    with open(path, "wb") as f:
        f.write(data)
    docs.sparkSession.sparkContext.addFile(path)    # the driver serves it; each executor fetches its own copy
    return os.path.basename(path)


def joined_parts(ids: np.ndarray, sizes: np.ndarray, part_of: dict[int, bytes], width: np.ndarray) -> list[bytes]:
    """Each word's parts (one of every id) joined, ``width`` being the parts' lengths."""
    whole = b"".join(map(part_of.__getitem__, ids.tolist()))
    ends = np.concatenate(([0], np.cumsum(width[ids])))[np.concatenate(([0], np.cumsum(sizes)))].tolist()
    return [whole[a:b] for a, b in zip(ends, ends[1:])]


class Encoder:
    """Encodes whole texts many at a time.

    Each known word is an entry: its ids in one pool, their decimal form and
    their bytes (without ``digests`` no decimal form).  Words of the automaton
    stay known until they are more than ``words``; other words are rare, so
    they are known for one call only.
    """

    def __init__(self, tokenizer: Tokenizer, lexicon: Lexicon, words: int = LEXICON_WORDS, digests: bool = True):
        self.tokenizer, self.lexicon, self.words, self.digests = tokenizer, lexicon, words, digests
        self.decimal_of = {i: b",%d" % i for i in tokenizer.bytes_of} if digests else {}
        self.decimal_width = np.zeros(len(tokenizer.width), np.int64)
        self.decimal_width[list(self.decimal_of)] = [*map(len, self.decimal_of.values())]
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.pool, self.starts, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.decimals: list[bytes] = []
        self.raw: list[bytes] = []
        self.rare: list[str] = []

    def _forget_rare(self) -> None:
        for word in self.rare:
            del self.index[word]
        kept = len(self.index)
        del self.decimals[kept:], self.raw[kept:]
        self.starts, self.sizes = self.starts[:kept], self.sizes[:kept]
        self.pool = self.pool[:int(self.sizes.sum())]
        self.rare = []

    def _learn(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate((self.starts, len(self.pool) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.pool = np.concatenate((self.pool, ids))
        if self.digests:
            self.decimals += joined_parts(ids, sizes, self.decimal_of, self.decimal_width)
        self.raw += joined_parts(ids, sizes, self.tokenizer.bytes_of, self.tokenizer.width)
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words))))

    def entries(self, texts: list[str]) -> list[np.ndarray]:
        """The entries of each text's words, in order; they hold until the next call."""
        self._forget_rare()
        if len(self.index) > self.words:
            self._forget()
        cut, number = self.tokenizer.cut_arrays(texts)
        words = cut.dictionary_encode()
        different = words.dictionary.cast(pa.large_string()).to_pylist()
        fresh = [w for w in different if w not in self.index]
        if fresh:
            tokenizer, lexicon = self.tokenizer, self.lexicon
            places = lexicon.places([w.encode("utf-8") for w in fresh])
            common = places[places >= 0]
            sizes = (lexicon.starts[common + 1] - lexicon.starts[common]).astype(np.int64)
            self._learn([fresh[k] for k in np.flatnonzero(places >= 0).tolist()],
                        lexicon.ids[spans(lexicon.starts[common].astype(np.int64), sizes)].astype(np.int32), sizes)
            rare = [fresh[k] for k in np.flatnonzero(places < 0).tolist()]
            special = [w for w in rare if w in tokenizer.special]
            if special:
                rare = [w for w in rare if w not in tokenizer.special]
                self._learn(special, np.array([tokenizer.special[w] for w in special], np.int32),
                            np.ones(len(special), np.int64))
            self._learn(rare, *tokenizer.encode_words([w.encode("utf-8") for w in rare]))
            self.rare = special + rare
        of_word = np.fromiter(map(self.index.__getitem__, different), np.int64, len(different))
        flat = of_word[words.indices.to_numpy()]
        return np.split(flat, np.cumsum(number)[:-1]) if len(number) else []

    def ids(self, entries: np.ndarray) -> np.ndarray:
        return self.pool[spans(self.starts[entries], self.sizes[entries])]

    def encode(self, text: str) -> list[int]:
        return self.ids(self.entries([text])[0]).tolist()


def steps(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with a bounded number of text bytes each (one row at least), and their texts."""
    size = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.unique(np.concatenate(([0], np.flatnonzero(np.diff(size // STEP_BYTES)) + 1, [batch.num_rows])))
    for at, past in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        some = batch.slice(at, past - at)
        yield some, some.column(column).to_pylist()


def with_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text",
                limit: int = LEXICON_WORDS) -> DataFrame:
    """The rows without their text, and with ``token_ids``, ``n_tokens`` and ``decodes`` (decoding the ids gives
    the text back); columns of these names in the input are replaced."""
    lexicon_name = publish_lexicon(docs, tokenizer_path, text_col, limit)
    made = ("token_ids", "n_tokens", "decodes")
    rest = [c for c in docs.columns if c not in (text_col, *made)]
    rows = small_batches(docs).select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("_row"),
                       text_or_empty(text_col).alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = from_worker("row-encoder", lexicon_name) or Encoder(
            from_worker("byte-tokenizer", tokenizer_path) or Tokenizer(tokenizer_path),
            Lexicon.map_file(SparkFiles.get(lexicon_name)), ROW_WORDS, False)
        for batch in batches:
            for some, texts in steps(batch, 1):
                found = encoder.entries(texts)
                exact = [b"".join(map(encoder.raw.__getitem__, own.tolist())) == text.encode("utf-8")
                         for own, text in zip(found, texts)]
                ids = [encoder.ids(own) for own in found]
                sizes = np.array([len(x) for x in ids], np.int64)
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([some.column(0), lists, pa.array(sizes), pa.array(exact, pa.bool_())],
                                                 names=["_row", *made])
        to_worker("row-encoder", lexicon_name, encoder)

    encoded = rows.mapInArrow(encode, T.StructType([
        rows.schema["_row"], T.StructField("token_ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_tokens", T.LongType()), T.StructField("decodes", T.BooleanType())]))
    return encoded.select(*[F.col("_row").getField(c).alias(c) for c in rest], *made)


def token_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  limit: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: whole texts encoded, then decoded from the ids."""
    lexicon_name = publish_lexicon(docs, tokenizer_path, text_col, limit)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = from_worker("digest-encoder", lexicon_name) or Encoder(
            from_worker("byte-tokenizer", tokenizer_path) or Tokenizer(tokenizer_path),
            Lexicon.map_file(SparkFiles.get(lexicon_name)))
        for batch in batches:
            counts, hashes, decoded = [], [], []
            for _, texts in steps(batch, 1):
                for entries in encoder.entries(texts):
                    own = entries.tolist()
                    counts.append(int(encoder.sizes[entries].sum()))
                    hashes.append(hashlib.sha256(b"".join(map(encoder.decimals.__getitem__, own))[1:]).hexdigest())
                    raw = b"".join(map(encoder.raw.__getitem__, own))
                    decoded.append(hashlib.sha256(raw.decode("utf-8", errors="replace").encode()).hexdigest())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(hashes, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())})
        to_worker("digest-encoder", lexicon_name, encoder)

    return small_batches(docs).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")) \
        .mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


ship_by_value(__name__)
