"""Near-duplicate detection with SetSketch registers.

A document's set is its distinct 5-word shingles (64-bit hashes of whole word
sequences).  Register i of its sketch is floor(1 - log_b(m_i)), where m_i is
the smallest of the set's exponentially distributed hash values: exponentially
spaced, truncated minima.  Sketches merge by the larger register, and two sets
share a register with probability close to their Jaccard similarity J.

1. Rows with equal sets form one class; everything below works on classes.
2. Registers are banded (``banding``: 32 bands of 6 at a threshold of 0.85, 38
   of 5 at 0.8); a bucket links its members to its smallest member, never to
   each other.  Components of these links are loose groups: any two classes
   that share a band are in one.  At the threshold two classes share none of
   the bands with probability 3e-7, at both thresholds.
3. A loose group is cut into blocks of at most about ``BLOCK`` classes, and
   each pair of blocks is one unit of work, so a group of any size spreads
   over many tasks of bounded memory.  In a unit, a pair goes on if the joint
   likelihood of its registers, given both set sizes, peaks at J >= ``floor``
   (five standard errors below the threshold), and is then confirmed on the
   full sets unless confirmed links already connect it.  A unit returns a
   spanning forest of its confirmed links, never all pairs.
4. Components of the confirmed links give the result.

Defined results: words are cut at ASCII white space after lower-casing A-Z; a
text with fewer than five words is one shingle; without words the set is empty
and links with nothing; a null text has no words; null ids take part but never
name a component (a component of null ids only has a null id, and its rows are
kept); repeated rows with the same id are kept alike; an empty table gives an
empty result; extra columns are carried along by ``near_dedup``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealsieve.llm.common import materialise, ship_by_value, small_batches, text_or_empty
from dealsieve.llm.graph import components
from dealsieve.llm.hashing import sequence_hashes, word_hashes

SHINGLE = 5
THRESHOLD = (85, 100)      # link when 100 * intersection >= 85 * union, unless another threshold is passed
REGISTERS = 192
BAND_MISS = 1e-6           # two classes at the threshold share none of the bands with at most this probability
BASE = 1.001               # b: ratio of neighbouring register boundaries
RATE = 20.0                # rate of the exponential hash values
LARGEST = (1 << 16) - 1    # registers are cut off at 16 bits
BLOCK = 512                # classes of a block, on average at most

SKETCH_SCHEMA = "doc_id long, text_hash long, n_shingles long, d1 long, d2 long, registers binary"


def banding(threshold: tuple[int, int]) -> tuple[int, int]:
    """(bands, rows of a band): as many rows as leave a pair at the threshold without a band at most ``BAND_MISS``."""
    j = threshold[0] / threshold[1]
    for rows in range(REGISTERS, 0, -1):
        if (1 - j ** rows) ** (REGISTERS // rows) <= BAND_MISS:
            return REGISTERS // rows, rows
    raise ValueError(f"{REGISTERS} registers cannot find pairs at {threshold[0]}/{threshold[1]}")


def floor(threshold: tuple[int, int]) -> float:
    """The similarity five standard errors of the registers' estimate below the threshold."""
    j = threshold[0] / threshold[1]
    return j - 5 * math.sqrt(j * (1 - j) / REGISTERS)


def register_hashes() -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets, one pair per register."""
    raw = np.frombuffer(b"".join(hashlib.blake2b(f"register {i}".encode(), digest_size=16).digest()
                                 for i in range(REGISTERS)), np.uint64).reshape(-1, 2)
    return raw[:, 0] | np.uint64(1), raw[:, 1]


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text in UTF-8."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(sequence_hashes(word_hashes(words), min(SHINGLE, len(words))))


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (sets x REGISTERS, 16 bits) of non-empty sets."""
    multiply, add = register_hashes()
    joined = np.concatenate(sets)
    begin = np.concatenate(([0], np.cumsum([len(s) for s in sets])))[:-1]
    least, work = np.empty((REGISTERS, len(sets)), np.uint64), np.empty_like(joined)
    for i in range(REGISTERS):
        np.multiply(joined, multiply[i], out=work)
        np.add(work, add[i], out=work)
        least[i] = np.minimum.reduceat(work, begin)
    share = (least.T.astype(np.float64) + 1.0) / 2.0 ** 64
    value = -np.log1p(-np.minimum(share, 1 - 2.0 ** -53)) / RATE
    return np.clip(np.floor(1 - np.log(value) / math.log(BASE)), 0, LARGEST).astype(np.uint16)


def likely_links(row: np.ndarray, others: np.ndarray, size: int, sizes: np.ndarray,
                 least: float = floor(THRESHOLD)) -> np.ndarray:
    """True where the joint likelihood of two sketches peaks at a Jaccard similarity of ``least`` or more.

    With sizes known, registers compare as larger, smaller or equal with
    probabilities p(u - vJ), p(v - uJ) and the rest, where u and v are the
    sizes' shares and p(x) = -log_b(1 - x (b - 1) / b).  The log-likelihood is
    concave in J, so its peak is at or above the floor if it rises there.
    """
    larger, equal = (row > others).sum(axis=1), (row == others).sum(axis=1)
    smaller = REGISTERS - larger - equal
    u = size / (size + sizes)
    v = 1 - u
    step = (BASE - 1) / BASE
    p = lambda x: -np.log1p(-x * step) / math.log(BASE)                       # noqa: E731
    slope = lambda x: step / ((1 - x * step) * math.log(BASE))                # noqa: E731
    above, under = np.maximum(u - v * least, 1e-9), np.maximum(v - u * least, 1e-9)
    up, down = v * slope(above), u * slope(under)
    rise = (-larger * up / p(above) - smaller * down / p(under)
            + equal * (up + down) / np.maximum(1 - p(above) - p(under), 1e-9))
    return rise >= 0


def linked(a: np.ndarray, b: np.ndarray, threshold: tuple[int, int] = THRESHOLD) -> bool:
    """Exact test of two sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return threshold[1] * common >= threshold[0] * (len(a) + len(b) - common)


def confirmed_forest(blocks: np.ndarray, registers: np.ndarray, sets: list[np.ndarray],
                     threshold: tuple[int, int] = THRESHOLD) -> list[tuple[int, int]]:
    """A spanning forest of the links within one block, or between two (``blocks``: block of each member)."""
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    parent, least = list(range(n)), floor(threshold)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    between = blocks.min() != blocks.max()
    forest = []
    for i in range(n - 1):
        others = np.arange(i + 1, n)
        fits = (threshold[1] * np.minimum(sizes[i], sizes[others]) >= threshold[0] * np.maximum(sizes[i], sizes[others]))
        others = others[fits & (blocks[others] != blocks[i])] if between else others[fits]
        if not len(others):
            continue
        others = others[likely_links(registers[i], registers[others], int(sizes[i]), sizes[others], least)]
        for j in others.tolist():
            a, b = root(i), root(j)
            if a != b and linked(sets[i], sets[j], threshold):
                parent[b] = a
                forest.append((i, j))
    return forest


# ---------------------------------------------------------------- Spark jobs

def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, text hash, set size, 128-bit digest of the set, registers (null if empty)."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):     # a few texts at a time stay in the processor's cache
                some = batch.slice(at, 200)
                sets = [shingle_set(t.as_py().encode("utf-8")) for t in some.column(2)]
                full = [s for s in sets if len(s)]
                rows = iter(sketch(full) if full else [])
                digests = [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64) for s in sets]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": some.column(0), "text_hash": some.column(1),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "d1": pa.array([d[0] for d in digests], pa.int64()),
                    "d2": pa.array([d[1] for d in digests], pa.int64()),
                    "registers": pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary())})

    text = text_or_empty(text_col)
    return small_batches(docs).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text")).mapInArrow(build, SKETCH_SCHEMA)


def band_keys(classes: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(node, key): one row per class and band; equal keys are equal registers of one band."""
    bands, rows = banding(threshold)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = np.repeat(batch.column(0).to_numpy(), bands)
            found = [xxhash.xxh3_64_intdigest(blob[2 * rows * b:2 * rows * (b + 1)], seed=b)
                     for blob in batch.column(1).to_pylist() for b in range(bands)]
            yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.int64()),
                                              "key": pa.array(np.array(found, np.uint64).view(np.int64))})
    return small_batches(classes).select("node", "registers").mapInArrow(keys, "node long, key long")


def loose_groups(classes: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(node, root): classes that share a band, directly or through others."""
    bands = materialise(band_keys(classes, threshold), "bands")
    # Stored, so that the join has an exchange of its own and a hot bucket can be split over tasks.
    centres = materialise(bands.groupBy("key").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n"))
                          .where("n > 1").select("key", "centre"), "centres")
    stars = bands.join(centres, "key").where("node != centre").select("node", "centre")
    return components(stars, "node", "centre")


def confirmed_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(a, b): spanning forests of the links confirmed on full sets, over all pairs of blocks of all groups."""
    sizes = materialise(groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("cuts")), "group-sizes")
    placed = groups.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("long"))
    members = placed.join(classes, "node").select("node", "root", "cuts", "block", "doc_id", "text_hash", "registers")
    text = text_or_empty(text_col)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.xxhash64(text).alias("_hash"),
                        text.alias("_text"))
    whole = members.join(texts, members["doc_id"].eqNullSafe(texts["_id"]) & (members["text_hash"] == texts["_hash"])) \
        .select("node", "root", "cuts", "block", "registers", "_text")

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py().encode("utf-8")).tobytes() for t in batch.column(5)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sets, pa.binary())],
                                             names=["node", "root", "cuts", "block", "registers", "shingles"])

    # The full sets are read once per pair of blocks, so they are stored rather than computed again.
    stored = materialise(whole.mapInArrow(with_sets, "node long, root long, cuts long, block long, registers binary, "
                                                     "shingles binary"), "sets")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1))
    units = stored.withColumn("other", other).select(
        "root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "node", "registers", "shingles")
    grouped = units.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "node")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, members = None, {}

        def forest():
            nodes = list(members)
            found = confirmed_forest(np.array([members[n][0] for n in nodes]),
                                     np.stack([np.frombuffer(members[n][1], np.uint16) for n in nodes]),
                                     [np.frombuffer(members[n][2], np.uint64) for n in nodes], threshold) if len(nodes) > 1 else []
            return pa.RecordBatch.from_pydict({"a": pa.array([nodes[i] for i, _ in found], pa.int64()),
                                               "b": pa.array([nodes[j] for _, j in found], pa.int64())})
        for batch in batches:
            for root, low, high, block, node, registers, shingles in zip(*(c.to_pylist() for c in batch.columns)):
                if (root, low, high) != unit:
                    if members:
                        yield forest()
                    unit, members = (root, low, high), {}
                members[node] = (block, registers, shingles)
        if members:
            yield forest()

    return grouped.mapInArrow(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept for every row; links from a similarity of ``threshold``."""
    rows = materialise(sketches(docs, id_col, text_col), "sketches")
    full = rows.where("n_shingles > 0")
    classes = materialise(full.dropDuplicates(["d1", "d2"]).withColumn("node", F.monotonically_increasing_id()),
                          "classes")
    groups = materialise(loose_groups(classes, threshold), "loose")
    links = materialise(confirmed_links(docs, classes, groups, id_col, text_col, threshold), "links")
    found = components(links, "a", "b")
    least = full.groupBy("d1", "d2").agg(F.min("doc_id").alias("class_id"))
    named = materialise(classes.select("node", "d1", "d2").join(least, ["d1", "d2"]).join(found, "node", "left")
                        .select("d1", "d2", "class_id", F.coalesce("root", "node").alias("root")), "named")
    roots = materialise(named.groupBy("root").agg(F.min("class_id").alias("component_id")), "roots")
    ids = named.join(roots, "root").select("d1", "d2", "component_id")
    out = rows.join(ids, ["d1", "d2"], "left").select(
        "doc_id", "text_hash", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """One document of each near-duplicate group (the smallest id), all columns unchanged."""
    judged = near_duplicates(docs, id_col, text_col, threshold).where("kept").select("doc_id", "text_hash").distinct()
    keys = judged.select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(f"`{id_col}`").cast("long").alias("_id"), F.xxhash64(text_or_empty(text_col)).alias("_hash"))
    stay = rows.join(keys, rows["_id"].eqNullSafe(keys["_kept_id"]) & (rows["_hash"] == keys["_kept_hash"]), "left_semi")
    return stay.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


ship_by_value(__name__)
