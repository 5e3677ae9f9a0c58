"""Secret scans with multipart credential linking.

A credential has parts: an access identifier, a secret, and often an endpoint.
Some patterns prove themselves (``assign``, ``access``, ``hex``); they are
always reported.  Weak candidates (a user name, a mixed run of letters and
digits, an address) are common in clean texts and are reported only where
complementary parts stand together: a weak secret needs an identifier, a weak
identifier needs a secret, an endpoint needs both.

"Together" is an interval join inside a scope, a run of lines without a blank
line between them: at most ``REACH`` code points lie between the two spans.
The join runs over sorted starts and ends (two binary searches a span), so a
text with very many parts costs no pairs.  Each identifier is linked with its
nearest secret, and with the nearest endpoint if there is one.

Texts without a secret's shape, seen by one pass of Arrow's regular
expressions over the whole text, have nothing to report.  Rows are
independent: no shuffle.

Defined results: a null or empty text has no spans; repeated rows are scanned
each; ties of start are ordered by kind; a text of any length is scanned
whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.llm.common import ship_by_value, small_batches, text_or_empty

REACH = 200
LEAST_SECRET, LEAST_ACCESS, LEAST_HEX = 6, 20, 24      # code points

# Patterns of the parts that are always reported (fixed values), ASCII letters in either case for ``assign``.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST_HEX)          # a run of the letters, if it is long enough

# Patterns of the weak parts.
IDENTIFIER = re.compile(r"""\b(?:user(?:_?name|_?id)?|login|client_?id|account(?:_?id)?|access_?key_?id)["']?\x20*[:=]\x20*["']?"""
                        r"[A-Za-z0-9._@+-]{3,}", re.I | re.A)
KEY = re.compile(r"[A-Za-z0-9+/_=-]{16,}")              # reported with lower case, upper case and a digit in it
ENDPOINT = re.compile(r"""\b(?:[a-z][a-z0-9+.-]{0,20}://|(?:host|server|endpoint)["']?\x20*[:=]\x20*["']?)[A-Za-z0-9][^\s"'<>,;]*""",
                      re.I | re.A)
BLANK_LINE = re.compile(r"\n[\x20\t\r]*(?=\n)")

KINDS = ["assign", "access", "hex", "identifier", "key", "endpoint"]
BASE = KINDS[:3]

# Any secret or access identifier holds one of these.
SHAPE = r"""(?i:password|passwd|secret|token|api_?key)["']? *[:=]|AKIA[A-Z0-9]|[0-9a-f]{24}|[A-Za-z0-9+/_=-]{16}"""

SCHEMA = ("doc_id long, spans array<struct<kind:string,start:long,past:long>>, "
          "links array<struct<identifier:long,secret:long,endpoint:long>>")


def _spans(pattern: re.Pattern, text: str, holds=None) -> np.ndarray:
    found = [m.span() for m in pattern.finditer(text) if holds is None or holds(m)]
    return np.array(found, np.int64).reshape(-1, 2)


def _mixed(m: re.Match) -> bool:
    value = m[0]
    return any("a" <= c <= "z" for c in value) and any("A" <= c <= "Z" for c in value) and any("0" <= c <= "9" for c in value)


def parts(text: str) -> dict[str, np.ndarray]:
    """(start, past the end) of every candidate of a text by kind; weak ones that touch no strong one."""
    out = {
        "assign": _spans(ASSIGN, text, lambda m: len(m[2]) >= LEAST_SECRET),
        "access": _spans(ACCESS, text, lambda m: m.end() - m.start() >= LEAST_ACCESS),
        "hex": _spans(HEX, text),
    }
    strong = np.concatenate(list(out.values()))
    for kind, weak in (("identifier", _spans(IDENTIFIER, text)), ("key", _spans(KEY, text, _mixed)),
                       ("endpoint", _spans(ENDPOINT, text))):
        out[kind] = weak[meeting(weak[:, 0] + 1, weak[:, 1] - 1, strong) == 0]
    # A run inside an address or a user name is part of it.
    own = np.concatenate([out["identifier"], out["endpoint"]])
    out["key"] = out["key"][meeting(out["key"][:, 0] + 1, out["key"][:, 1] - 1, own) == 0]
    return out


def meeting(low: np.ndarray, high: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """How many spans begin at or before ``high`` and do not end before ``low``."""
    begun = np.searchsorted(np.sort(spans[:, 0]), high, "right")
    ended = np.searchsorted(np.sort(spans[:, 1]), low, "left")
    return begun - ended


def windows(spans: np.ndarray, borders: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The interval in which a complementary part must stand: ``reach`` to both sides, inside the scope."""
    scope = np.searchsorted(borders, spans[:, 0], "right")
    first = np.concatenate([[0], borders])[scope]
    last = np.concatenate([borders, [np.iinfo(np.int64).max]])[scope] - 1
    return np.maximum(spans[:, 0] - reach, first), np.minimum(spans[:, 1] + reach, last)


def nearest(spans: np.ndarray, others: np.ndarray, borders: np.ndarray, reach: int) -> np.ndarray:
    """Start of the other span with the smallest gap, in reach and in the scope (ties: the earlier one), or -1.

    One kind's spans may lie in another's, so the span that ends last among
    those that begin before is looked up by a running maximum.
    """
    out = np.full(len(spans), -1, np.int64)
    if not len(others) or not len(spans):
        return out
    low, high = windows(spans, borders, reach)
    others = others[np.lexsort((others[:, 1], others[:, 0]))]
    starts = others[:, 0]
    ends = np.maximum.accumulate(others[:, 1])
    # The earliest of the spans with the running maximum.
    holder = np.searchsorted(ends, ends, "left")
    after = np.searchsorted(starts, spans[:, 0], "left")
    left, right = np.maximum(after - 1, 0), np.minimum(after, len(others) - 1)
    never = np.iinfo(np.int64).max
    gap_left = np.where((after > 0) & (ends[left] >= low), np.maximum(spans[:, 0] - ends[left], 0), never)
    gap_right = np.where((after < len(others)) & (starts[right] <= high), np.maximum(starts[right] - spans[:, 1], 0), never)
    found = np.minimum(gap_left, gap_right) < never
    out[found] = np.where(gap_left <= gap_right, starts[holder[left]], starts[right])[found]
    return out


def link(text: str, reach: int = REACH) -> tuple[list[tuple[str, int, int]], list[tuple[int, int, int | None]]]:
    """All reported spans by start and kind, and the links (identifier, secret, endpoint), each by its start."""
    found = parts(text)
    borders = np.array([m.end() for m in BLANK_LINE.finditer(text)], np.int64)
    identifiers = np.concatenate([found["access"], found["identifier"]])
    secrets = np.concatenate([found["assign"], found["hex"], found["key"]])

    def near(kind: str, others: np.ndarray) -> np.ndarray:
        return meeting(*windows(found[kind], borders, reach), others) > 0

    kept = {kind: found[kind] for kind in BASE}
    kept["identifier"] = found["identifier"][near("identifier", secrets)]
    kept["key"] = found["key"][near("key", identifiers)]
    kept["endpoint"] = found["endpoint"][near("endpoint", identifiers) & near("endpoint", secrets)]
    spans = sorted(((start, KINDS.index(kind), kind, past) for kind in KINDS for start, past in kept[kind].tolist()))
    linked = identifiers[np.lexsort((identifiers[:, 1], identifiers[:, 0]))]
    to_secret = nearest(linked, secrets, borders, reach)
    to_endpoint = nearest(linked, kept["endpoint"], borders, reach)
    links = [(a, b, None if c < 0 else c) for (a, _), b, c in zip(linked.tolist(), to_secret.tolist(), to_endpoint.tolist())
             if b >= 0]
    return [(kind, start, past) for start, _, kind, past in spans], links


def scan_credentials(docs: DataFrame, reach: int = REACH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans (kind, start, past the end, in code points) and links of every row."""
    kinds = pa.schema([
        ("doc_id", pa.int64()),
        ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("past", pa.int64())]))),
        ("links", pa.list_(pa.struct([("identifier", pa.int64()), ("secret", pa.int64()), ("endpoint", pa.int64())])))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shaped = pc.match_substring_regex(batch.column(1), SHAPE).to_pylist()
            rows = []
            for i, text, some in zip(batch.column(0).to_pylist(), batch.column(1), shaped):
                spans, links = link(text.as_py(), reach) if some else ([], [])
                rows.append({"doc_id": i, "spans": [{"kind": k, "start": a, "past": b} for k, a, b in spans],
                             "links": [{"identifier": a, "secret": b, "endpoint": c} for a, b, c in links]})
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return small_batches(docs).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")) \
        .mapInArrow(scan, SCHEMA)


ship_by_value(__name__)
