"""Substring deduplication over super-k-mers.

A window is ``WINDOW`` consecutive words of one document.  A window's
minimiser is the smallest hash of the ``MINI``-word sequences inside it;
consecutive windows with the same minimiser form a super-k-mer, which travels
as one packed string to the bucket of its minimiser.  Equal windows have equal
minimisers, so they meet in one bucket, where sorting puts them next to each
other and comparing neighbours on all their words counts them exactly.  Every
occurrence but the first (smallest document id, then earliest start) marks its
words for removal.

Hot passages are combined before they travel: a task sends each distinct
super-k-mer once, from its earliest place, and marks the other places of its
own at once.  Tasks work on a bounded size of text at a time, and the number
of buckets follows the size of the texts.

Hot minimisers are split: the bytes of the different super-k-mers under each
minimiser are summed first, and where they pass a bucket's size (none below
half of it), each window travels by itself to the bucket of the hash of all
its words.  Equal windows still meet, and each is compared in full.  Tasks know
the hot ones by a map of 2 ** ``HOT_BITS`` bits, whatever the input: another
minimiser that falls on a set bit is split as well, by every task alike.

Defined results: a null text has no words; rows are ordered by id, null ids
last, and rows with the same id by their text's hash; a repeated row (same id
and text) is the same document, so it is not a copy of itself; an empty table
gives an empty result; extra columns are carried along by ``drop_windows``.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealsieve.llm.common import materialise, ship_by_value, small_batches, text_or_empty
from dealsieve.llm.hashing import mixed, sequence_hashes, word_hashes

WINDOW = 20                 # words of a window
MINI = 3                    # words of a minimiser's sequence
CHUNK_BYTES = 4 << 20       # text bytes a task packs at a time
BUCKET_BYTES = 3 << 20      # text bytes per bucket
SLICE_ROWS = 500            # rows reduced at a time
HOT_BITS = 22               # hot minimisers are marked in a map of 2 ** HOT_BITS places

ROWS_SCHEMA = "bucket int, packed binary"
MARKS_SCHEMA = "doc_id long, text_hash long, first long, past long"


def sliding_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values, by doubling."""
    if len(values) < width:
        return values[:0]
    span, out = 1, values
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


class Documents:
    """Order keys of a chunk's documents: null flag, id, text hash."""

    def __init__(self, null, ids, hashes):
        self.null, self.ids, self.hashes = null, ids, hashes

    def take(self, at):
        return Documents(self.null[at], self.ids[at], self.hashes[at])

    def order(self, starts: np.ndarray) -> np.ndarray:
        return np.lexsort((starts, self.hashes, self.ids, self.null))


# ---------------------------------------------------------------- packing

PACK = "<qqqq"      # documents, super-k-mers, known copies, bytes of text


def pack(docs: Documents, of_doc, starts, windows, copies, text: bytes) -> bytes:
    """One bucket's share of a chunk: super-k-mers (document, start, windows, words) and known copies."""
    used, doc = np.unique(np.concatenate((of_doc, copies[0])), return_inverse=True)
    own = docs.take(used)
    return zstandard.ZstdCompressor(level=3).compress(b"".join([
        struct.pack(PACK, len(used), len(starts), len(copies[0]), len(text)),
        own.ids.astype(np.int64).tobytes(), own.hashes.astype(np.int64).tobytes(), own.null.astype(np.uint8).tobytes(),
        doc.astype(np.int32).tobytes(), starts.astype(np.int64).tobytes(), windows.astype(np.int32).tobytes(),
        copies[1].astype(np.int64).tobytes(), copies[2].astype(np.int32).tobytes(), text]))


def unpack(blob: bytes):
    """(documents, document of each super-k-mer, starts, windows, copies, text)."""
    data = zstandard.ZstdDecompressor().decompress(blob)
    n_docs, n, n_copies, n_text = struct.unpack_from(PACK, data, 0)
    at = struct.calcsize(PACK)

    def array(kind, count):
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out
    ids, hashes, null = array(np.int64, n_docs), array(np.int64, n_docs), array(np.uint8, n_docs)
    doc = array(np.int32, n + n_copies)
    starts, windows = array(np.int64, n), array(np.int32, n)
    copies = doc[n:], array(np.int64, n_copies), array(np.int32, n_copies)
    return Documents(null, ids, hashes), doc[:n], starts, windows, copies, data[at:at + n_text]


def word_numbers(text: bytes) -> tuple[np.ndarray, int]:
    """A number for every word of a text (each word closed by one blank), equal for equal words; how many there are."""
    if not text:
        return np.empty(0, np.int32), 0
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 32) + 1
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(text)])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), len(coded.dictionary)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every span, one after the other."""
    past = np.cumsum(lengths)
    return np.repeat(starts - (past - lengths), lengths) + np.arange(int(past[-1]) if len(past) else 0)


def cut_chunk(texts: list[bytes], docs: Documents, hot: np.ndarray | None):
    """The super-k-mers of a chunk: strings, document, place, windows, minimiser, hash to deal by, whether its
    minimiser is hot, whether the string is the chunk's first of its kind; None without any."""
    words: list[bytes] = []
    kept, counts, seen = [], [], set()
    for d in docs.order(np.zeros(len(texts), np.int64)).tolist():   # so that the first place seen is the earliest
        row = (docs.null[d], docs.ids[d], docs.hashes[d])
        own = texts[d].split() if row not in seen else []
        seen.add(row)
        if len(own) >= WINDOW:
            kept.append(d)
            counts.append(len(own))
            words += own
    if not kept:
        return None
    text = b" ".join(words) + b" "
    past = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)     # where each word's blank ends
    hashes = word_hashes(words)
    minima = sliding_minima(sequence_hashes(hashes, MINI), WINDOW - MINI + 1)
    single = np.zeros(len(minima), bool) if hot is None else hot[hot_places(minima)]
    del words
    ends = np.cumsum(counts)
    doc_start = ends - counts
    inside = np.ones(len(minima), bool)          # windows that do not run over the end of their document
    for k in range(1, WINDOW):
        cut = ends - k
        inside[cut[cut < len(minima)]] = False
    fresh = inside.copy()
    fresh[1:] &= (minima[1:] != minima[:-1]) | ~inside[:-1] | single[1:]
    starts = np.flatnonzero(fresh)
    windows = np.bincount(np.cumsum(fresh)[inside] - 1, minlength=len(starts))
    doc = np.searchsorted(ends, starts, "right")
    single, least = single[starts], minima[starts]
    deal = np.where(single, sequence_hashes(hashes, WINDOW)[starts], least) if single.any() else least
    places = (starts - doc_start[doc]).astype(np.int64)
    of_doc = np.array(kept)[doc]
    begin = np.concatenate(([0], past))[starts].tolist()
    end = past[starts + windows + WINDOW - 2].tolist()
    first_place: dict[bytes, int] = {}
    strings = [text[a:b] for a, b in zip(begin, end)]
    is_first = np.fromiter((first_place.setdefault(x, j) == j for j, x in enumerate(strings)), bool, len(strings))
    return strings, of_doc, places, windows, least, deal, single, is_first


def hot_places(minimisers: np.ndarray) -> np.ndarray:
    """Places of minimisers in the map of hot ones."""
    return (mixed(minimisers) >> np.uint64(64 - HOT_BITS)).astype(np.int64)


def minimiser_bytes(texts: list[bytes], docs: Documents, share: float) -> tuple[np.ndarray, np.ndarray]:
    """(minimiser, bytes) of a chunk's different super-k-mers, where it has more bytes than ``share``."""
    cut = cut_chunk(texts, docs, None)
    if cut is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    strings, *_, least, _, _, is_first = cut
    found, number = np.unique(least, return_inverse=True)
    size = np.bincount(number, np.fromiter(map(len, strings), np.int64, len(strings)) * is_first, len(found))
    return found[size > share], size[size > share].astype(np.int64)


def super_kmers(texts: list[bytes], docs: Documents, buckets: int,
                hot: np.ndarray | None = None) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed share) of a chunk of documents."""
    cut = cut_chunk(texts, docs, hot)
    if cut is None:
        return
    strings, of_doc, places, windows, _, deal, single, is_first = cut
    # Known copies are not compared again, so those of a hot minimiser go by their document.
    deal = np.where(single & ~is_first, docs.hashes[of_doc].astype(np.int64).view(np.uint64), deal)
    bucket = (mixed(deal) % np.uint64(buckets)).astype(np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    present, first = np.unique(bucket[by_bucket], return_index=True)
    for b, own in zip(present.tolist(), np.split(by_bucket, first[1:])):
        if len(own):
            sent, known = own[is_first[own]], own[~is_first[own]]
            yield b, pack(docs, of_doc[sent], places[sent], windows[sent],
                          (of_doc[known], places[known], windows[known]), b"".join([strings[j] for j in sent.tolist()]))


# ---------------------------------------------------------------- counting in a bucket

def _not_first(words: np.ndarray, at: np.ndarray, place: np.ndarray, gids: int) -> np.ndarray:
    """For window starts ``at`` (earliest first): True where equal words start at an earlier place.

    ``place`` numbers the places in order; equal numbers are the same place.
    """
    word_hash = mixed(np.arange(1, gids + 1, dtype=np.uint64))
    keys = sequence_hashes(word_hash[words], WINDOW)[at]
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(at), bool)
    same[1:] = keys[order[1:]] == keys[order[:-1]]
    later, before = at[order[1:]][same[1:]], at[order[:-1]][same[1:]]
    equal = np.ones(len(later), bool)
    for k in range(WINDOW):
        equal &= words[later + k] == words[before + k]
    if not equal.all():      # two different windows share a hash: sort these by their words as well
        view = np.lib.stride_tricks.sliding_window_view(words, WINDOW)
        order = np.lexsort((np.arange(len(at)), *view[at].T[::-1]))
        same[1:] = (view[at[order[1:]]] == view[at[order[:-1]]]).all(axis=1)
    run = np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))      # where each run of equals begins
    out = np.zeros(len(at), bool)
    out[order] = same & (place[order] > place[order[run]])
    return out


def bucket_marks(blobs: list[bytes]) -> dict[str, np.ndarray]:
    """Marked word spans of one bucket: doc_id (with null flag), text_hash, first, past."""
    parts, known, texts = [], [], []
    for blob in blobs:
        docs, doc, starts, windows, copies, text = unpack(blob)
        own = docs.take(doc)
        parts.append((own.null, own.ids, own.hashes, starts, windows))
        texts.append(text)
        other = docs.take(copies[0])
        known.append((other.null, other.ids, other.hashes, copies[1], copies[1] + copies[2] + WINDOW - 1))
    null, ids, hashes, starts, windows = (np.concatenate(x) for x in zip(*parts))
    words, different = word_numbers(b"".join(texts))
    del texts
    if len(starts):
        windows = windows.astype(np.int64)
        word_at = np.cumsum(windows + WINDOW - 1) - (windows + WINDOW - 1)
        order = Documents(null, ids, hashes).order(starts)
        null, ids, hashes, starts, windows, word_at = (x[order] for x in (null, ids, hashes, starts, windows, word_at))
        at = spans(word_at, windows)
        begin = np.cumsum(windows) - windows
        # Windows in order of place: super-k-mers are in that order, and windows inside one follow each other.
        changed = np.ones(len(starts), bool)
        changed[1:] = (null[1:] != null[:-1]) | (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])
        doc_number = np.repeat(np.cumsum(changed), windows)
        start = spans(starts, windows)
        moved = np.ones(len(start), bool)
        moved[1:] = (doc_number[1:] != doc_number[:-1]) | (start[1:] != start[:-1])
        marked = _not_first(words, at, np.cumsum(moved), different)
        owner = np.repeat(np.arange(len(starts)), windows)
        edge = marked.copy()
        edge[1:] &= ~marked[:-1] | (owner[1:] != owner[:-1])
        first = np.flatnonzero(edge)
        length = np.bincount(np.cumsum(edge)[marked] - 1, minlength=len(first))
        k = owner[first]
        word = starts[k] + first - begin[k]
        known.append((null[k], ids[k], hashes[k], word, word + length + WINDOW - 1))
    names = ("null", "doc_id", "text_hash", "first", "past")
    return dict(zip(names, (np.concatenate(x).astype(np.int64) for x in zip(*known))))


# ---------------------------------------------------------------- Spark jobs

def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], Documents]]:
    """Texts and order keys of about ``CHUNK_BYTES`` at a time."""
    held, size = [], 0

    def taken():
        ids = [r[0] for r in held]
        return [r[2] for r in held], Documents(np.array([i is None for i in ids]),
                                               np.array([i or 0 for i in ids], np.int64),
                                               np.array([r[1] for r in held], np.int64))
    for batch in batches:
        for doc_id, text_hash, text in zip(*batch.columns):
            raw = text.as_buffer().to_pybytes()
            held.append((doc_id.as_py(), text_hash.as_py(), raw))
            size += len(raw)
            if size >= CHUNK_BYTES:
                yield taken()
                held, size = [], 0
    if held:
        yield taken()


def hot_minimisers(rows: DataFrame, total: int, bucket_bytes: int) -> np.ndarray:
    """The map of minimisers whose different super-k-mers pass a bucket's size, as 2 ** ``HOT_BITS`` flags.

    A chunk leaves out what is below its share of half a bucket, so what is
    left out of a minimiser is less than half a bucket over all chunks.
    """
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, docs in chunks(batches):
            found, size = minimiser_bytes(texts, docs, bucket_bytes / 2 * sum(map(len, texts)) / max(total, 1))
            yield pa.RecordBatch.from_pydict({"minimiser": pa.array(found.view(np.int64), pa.int64()),
                                              "n": pa.array(size, pa.int64())})
    summed = rows.mapInArrow(sizes, "minimiser long, n long").groupBy("minimiser").agg(F.sum("n").alias("n"))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = hot_places(batch.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_pydict({"place": pa.array(at)})

    # Places, not minimisers, reach the driver: at most 2 ** HOT_BITS of them.
    found = summed.where(F.col("n") > bucket_bytes // 2).select("minimiser").mapInArrow(places, "place long").distinct().collect()
    out = np.zeros(1 << HOT_BITS, bool)
    out[[r.place for r in found]] = True
    return out


def dealt_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, packed): the super-k-mers of all texts."""
    text = text_or_empty(text_col)
    total = docs.select(F.octet_length(text).cast("long").alias("n")).agg(F.sum("n")).first()[0] or 0
    buckets = max(16, math.ceil(total / BUCKET_BYTES))

    rows = small_batches(docs).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text"))
    hot = np.packbits(hot_minimisers(rows, total, BUCKET_BYTES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(hot).astype(bool)
        for texts, keys in chunks(batches):
            out = list(super_kmers(texts, keys, buckets, marked))
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([b for b, _ in out], pa.int32()),
                                              "packed": pa.array([p for _, p in out], pa.binary())})

    return rows.mapInArrow(cut, ROWS_SCHEMA)


def marked_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, first, past): word spans covered by windows that also start earlier."""
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        found = bucket_marks(pdf["packed"].tolist())
        ids = pd.Series(found["doc_id"], dtype="Int64").mask(found["null"] == 1)
        return pd.DataFrame({"doc_id": ids, "text_hash": found["text_hash"],
                             "first": found["first"], "past": found["past"]})

    return dealt_windows(docs, id_col, text_col).groupBy("bucket").applyInPandas(count, MARKS_SCHEMA)


def keep_unmarked(text: bytes, marks: list[dict]) -> tuple[bytes, int, int]:
    """The words outside the marked spans joined by one blank, the number of words, and of words left out."""
    words = text.split()
    if not marks:
        return b" ".join(words), len(words), 0
    change = np.zeros(len(words) + 1, np.int64)
    for m in marks:
        change[m["first"]] += 1
        change[m["past"]] -= 1
    gone = np.cumsum(change)[:-1] > 0
    return b" ".join(compress(words, (~gone).tolist())), len(words), int(gone.sum())


def drop_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its text reduced to the kept words, one blank between them, and further columns
    ``n_words``, ``n_removed`` and ``marks`` (the removed spans of words), in place of input columns of these
    names."""
    marks = materialise(marked_spans(docs, id_col, text_col), "window-marks")
    per_doc = marks.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("first", "past")).alias("_marks"))
    made = ("n_words", "n_removed", "marks")
    rest = [c for c in docs.columns if c not in (text_col, *made)]
    rows = small_batches(docs).select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("_row"),
                       F.col(f"`{id_col}`").cast("long").alias("_id"), text_or_empty(text_col).alias("_text")) \
        .withColumn("_hash", F.xxhash64("_text"))
    spans_type = "array<struct<first:long,past:long>>"
    joined = rows.join(per_doc, rows["_id"].eqNullSafe(per_doc["doc_id"]) & (rows["_hash"] == per_doc["text_hash"]),
                       "left").select("_row", "_text", F.coalesce("_marks", F.array().cast(spans_type)).alias("_marks"))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                some = batch.slice(at, SLICE_ROWS)
                out = [keep_unmarked(t.as_buffer().to_pybytes(), m) for t, m in
                       zip(some.column(1), some.column(2).to_pylist())]
                kept, words, gone = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(words, pa.int64()),
                     pa.array(gone, pa.int64()), some.column(2)],
                    names=["_row", "_text", "n_words", "n_removed", "marks"])

    reduced = joined.mapInArrow(reduce, T.StructType([
        joined.schema["_row"], joined.schema["_text"], T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("marks", joined.schema["_marks"].dataType)]))
    own = [F.col("_text").alias(c) if c == text_col else F.col("_row").getField(c).alias(c)
           for c in docs.columns if c not in made]
    return reduced.select(*own, *made)


ship_by_value(__name__)
