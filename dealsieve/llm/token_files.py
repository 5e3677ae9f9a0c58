"""Token-ID files with Re-Pair grammar compression.

Texts are range-partitioned by document id, encoded, and written in ascending
id order as shards of about ``SHARD_IDS`` ids.  A shard is one binary blob
(one row of a Parquet table, so Spark's commit protocol guards it): frequent
neighbouring pairs of symbols are repeatedly replaced by nonterminals, in
rounds that take the most frequent pairs at once, until no pair pays
for its rule, and the rules are stored
with the length each nonterminal expands to.  No pair crosses the end of a
document, so a document, or a range of its ids, is decoded without the rest
of its shard: the expansion lengths say which symbols hold the range.

Texts are cut into the tokenizer's pieces, and each distinct piece that a
worker remembers is encoded once by the tokenizer's library; a worker keeps
its encoder from task to task.

Blob layout (little-endian): magic, counts, then arrays - alphabet ids,
rules (two symbols each), expansion length per symbol, first symbol of each
document, document ids, their null flags, and the symbols.

Defined results: a null text counts as empty (only the end id); a null id
sorts after every other id; repeated rows are stored one after the other; an
empty table gives an empty shard table; extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealsieve.llm.common import from_worker, new_path, ship_by_value, small_batches, text_or_empty, to_worker

END_ID = 1
SHARD_IDS = 1 << 19      # ids after which a shard is closed
RULE_BYTES = 12          # a rule's two symbols and its expansion length in the blob
SLOT_BITS = 17           # hash slots that bound a round's counts (2 ** SLOT_BITS)
STEP = 16                # a round takes pairs down to this part of the highest count
WORD_MEMORY = 300_000    # distinct pieces a worker remembers at once
STEP_BYTES = 4 << 20     # text bytes encoded at once

MAGIC = b"REPAIR01"
HEADER = "<8sqqqqq"      # magic, documents, symbols, alphabet size, rules, ids
SHARD_SCHEMA = "part int, seq int, n_docs long, n_ids long, blob binary"


# ---------------------------------------------------------------- grammar

def _frequent_pairs(keys: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank of each pair among the round's pairs (their number where it is none), which pairs may still pay, and
    the round's pairs.

    A round takes the pairs that are at least about a sixteenth as frequent as the most
    frequent one (or seen ``most`` times) and that pay for their rule.  A count by a hash of
    the pair, never below the pair's own, tells which places to sort; their
    pairs are then counted exactly, and the bound is lowered until a pair is
    found or none can be left.
    """
    slot = (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    held = np.bincount(slot, minlength=1 << SLOT_BITS)[slot]
    bound = max(least, min(int(held.max(initial=0)) // STEP, most))
    while True:
        some = np.flatnonzero(held >= bound)
        order = np.argsort(keys[some])
        own = keys[some][order]
        begins = np.flatnonzero(np.concatenate((np.ones(min(len(own), 1), bool), own[1:] != own[:-1])))
        counts = np.diff(np.append(begins, len(own)))
        chosen = np.flatnonzero(counts >= bound)
        if len(chosen) or bound == least:
            break
        bound = max(least, bound // STEP)
    may_pay = held >= least
    may_pay[some[order]] = np.repeat(counts >= least, counts)
    chosen = chosen[np.argsort(-counts[chosen], kind="stable")]         # on ties the smaller pair
    rank_of = np.full(len(counts), len(chosen), np.int32)
    rank_of[chosen] = np.arange(len(chosen), dtype=np.int32)
    rank = np.full(len(keys), len(chosen), np.int32)
    rank[some[order]] = np.repeat(rank_of, counts)
    return rank, may_pay, own[begins[chosen]]


def compress(symbols: np.ndarray, ends: np.ndarray, alphabet: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair of a symbol sequence: (symbols, their end-of-document flags, rules).

    Symbols below ``alphabet`` are terminals, ``alphabet + i`` expands to rule
    i.  ``ends`` marks the last symbol of each document.  Where chosen pairs
    overlap, the more frequent one (on ties the left one) is replaced.  Rounds
    go on until no pair pays: until none is replaced so often that the symbols
    saved take more bytes than the rule.

    No later round finds a pair of old symbols more often than this one, so a
    place whose pair is too rare to pay is not looked at again until a rule
    changes one of its two symbols.
    """
    rules, most = [np.empty((0, 2), np.uint32)], len(symbols)
    symbols, ends = symbols.copy(), ends.copy()
    n_rules, places = 0, np.flatnonzero(~ends[:-1])         # places whose pair may pay, ascending
    while len(places):
        width = 2 if alphabet + n_rules <= 1 << 16 else 4
        least = RULE_BYTES // width + 1
        keys = (symbols[places].astype(np.uint64) << np.uint64(32)) | symbols[places + 1]
        rank, may_pay, pairs = _frequent_pairs(keys, least, most)
        if not len(pairs):
            break
        some = rank < len(pairs)
        at, ranks = places[some], rank[some]
        places = places[may_pay]
        beside = np.diff(at) == 1
        hit = np.ones(len(at), bool)
        hit[1:] &= ~beside | (ranks[1:] <= ranks[:-1])
        hit[:-1] &= ~beside | (ranks[:-1] <= ranks[1:])
        at, ranks = at[hit], ranks[hit]
        # Neighbouring hits have one rank (a run of one symbol): every other place of the run is taken.
        begins = np.concatenate(([True], np.diff(at) != 1))[:len(at)]
        odd = (at - at[np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))]) % 2 == 0
        at, ranks = at[odd], ranks[odd]
        used = np.bincount(ranks, minlength=len(pairs))
        number = np.cumsum(used >= least) - 1               # a pair taken less often would only cost a rule
        paid = used[ranks] >= least
        take, fresh = at[paid], alphabet + n_rules + number[ranks[paid]]
        if not len(take):
            if most == least:
                break
            most = least                                    # runs hide the less frequent pairs: take all at once
            continue
        most = len(symbols)
        new = pairs[used >= least]
        rules.append(np.stack((new >> np.uint64(32), new & np.uint64(0xFFFFFFFF)), 1).astype(np.uint32))
        n_rules += len(new)
        # Looked at next: the places that may pay, the changed symbols and those before them (where one of these
        # goes, the symbol before it is a changed one).
        look = np.zeros(len(symbols), bool)
        look[places] = look[take] = True
        look[np.maximum(take, 1) - 1] = True
        symbols[take] = fresh
        ends[take] = ends[take + 1]
        stay = np.ones(len(symbols), bool)
        stay[take + 1] = False
        symbols, ends, look = symbols[stay], ends[stay], look[stay]
        look &= ~ends
        look[-1] = False
        places = np.flatnonzero(look)
    return symbols, ends, np.concatenate(rules)


def rule_runs(alphabet: int, rules: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs (first rule, rule after the last) of consecutive rules that use symbols from before their run only."""
    latest = np.maximum.accumulate(rules.max(axis=1).astype(np.int64)) if len(rules) else np.empty(0, np.int64)
    at = 0
    while at < len(rules):
        past = int(np.searchsorted(latest, alphabet + at))
        yield at, past
        at = past


def expansions(alphabet: int, rules: np.ndarray) -> np.ndarray:
    """Terminals that each symbol expands to (rules only use earlier symbols)."""
    lengths = np.ones(alphabet + len(rules), np.int64)
    for at, past in rule_runs(alphabet, rules):
        lengths[alphabet + at:alphabet + past] = lengths[rules[at:past]].sum(axis=1)
    return lengths


class Shard:
    """A shard's blob, decoded whole or in part."""

    def __init__(self, blob: bytes):
        magic, docs, symbols, alphabet, rules, self.n_ids = struct.unpack_from(HEADER, blob, 0)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize(HEADER)

        def array(kind, n):
            nonlocal at
            out = np.frombuffer(blob, kind, n, at)
            at += out.nbytes
            return out
        self.alphabet = array(np.uint32, alphabet)
        self.rules = array(np.uint32, 2 * rules).reshape(-1, 2)
        self.lengths = array(np.uint32, alphabet + rules)
        self.first = array(np.int64, docs + 1)          # first symbol of each document
        self.doc_ids = array(np.int64, docs)
        self.null_ids = array(np.uint8, docs).astype(bool)
        self.symbols = array(np.uint16 if alphabet + rules <= 1 << 16 else np.uint32, symbols)
        self._pool = None

    def _expansion_pool(self) -> tuple[np.ndarray, np.ndarray]:
        """Every symbol's terminals one after the other, and where each symbol's start."""
        if self._pool is None:
            n = len(self.alphabet)
            starts = np.concatenate(([0], np.cumsum(self.lengths, dtype=np.int64)))
            pool = np.empty(starts[-1], np.uint32)
            pool[:n] = self.alphabet
            for at, past in rule_runs(n, self.rules):
                two = self.rules[at:past].ravel()
                pool[starts[n + at]:starts[n + past]] = pool[spans(starts[two], self.lengths[two].astype(np.int64))]
            self._pool = pool, starts
        return self._pool

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        pool, starts = self._expansion_pool()
        return pool[spans(starts[symbols], self.lengths[symbols].astype(np.int64))]

    def document(self, k: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the k-th document; only the symbols that hold them are expanded."""
        own = self.symbols[self.first[k]:self.first[k + 1]]
        past = np.cumsum(self.lengths[own], dtype=np.int64)
        stop = int(past[-1]) if stop is None else min(stop, int(past[-1]))
        if start >= stop:
            return np.empty(0, np.uint32)
        a, b = np.searchsorted(past, start, "right"), np.searchsorted(past, stop, "left") + 1
        skipped = int(past[a - 1]) if a else 0
        return self.expand(own[a:b])[start - skipped:stop - skipped]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(id, ids) of every document in order."""
        ids = self.expand(self.symbols)
        sizes = np.add.reduceat(self.lengths[self.symbols].astype(np.int64), self.first[:-1]) \
            if len(self.doc_ids) else []
        at = 0
        for doc_id, null, n in zip(self.doc_ids.tolist(), self.null_ids.tolist(), sizes):
            yield (None if null else doc_id), ids[at:at + n]
            at += int(n)


def build_shard(doc_ids: list[int | None], ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """The blob of consecutive documents: all ids in order and the number of ids of each document (at least 1)."""
    present = np.zeros(int(ids.max()) + 1, bool)
    present[ids] = True
    alphabet = np.flatnonzero(present).astype(np.uint32)
    dense = np.zeros(len(present), np.uint32)
    dense[alphabet] = np.arange(len(alphabet), dtype=np.uint32)
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(lengths) - 1] = True
    symbols, ends, rules = compress(dense[ids], ends, len(alphabet))
    first = np.concatenate(([0], np.flatnonzero(ends) + 1)).astype(np.int64)
    width = np.uint16 if len(alphabet) + len(rules) <= 1 << 16 else np.uint32
    return b"".join([
        struct.pack(HEADER, MAGIC, len(doc_ids), len(symbols), len(alphabet), len(rules), len(ids)),
        alphabet.tobytes(), rules.astype(np.uint32).tobytes(),
        expansions(len(alphabet), rules).astype(np.uint32).tobytes(), first.tobytes(),
        np.array([d or 0 for d in doc_ids], np.int64).tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(), symbols.astype(width).tobytes()])


# ---------------------------------------------------------------- encoding

# On texts of these characters the tokenizer cuts as below (fixed values): lower-casing maps them one
# by one, no normalisation changes them, and a piece is a run of letters, one digit, or a run of others.
UNSAFE = re.compile("[^\\x00-\\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]"
                    "|[^\\x09-\\x0d\\x20a-z\u00df-\u00f6\u00f8-\u00ff0-9]+")
WHITE, LETTER, DIGIT, OTHER = range(4)
KINDS = np.full(256, OTHER, np.uint8)       # by byte of lower-cased UTF-8
KINDS[[*range(9, 14), 32]] = WHITE
KINDS[[*range(ord("a"), ord("z") + 1), 0xC3, *range(0x80, 0xC0)]] = LETTER
KINDS[[*range(ord("0"), ord("9") + 1)]] = DIGIT
WORD_END = "</w>"


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every span, one after the other."""
    past = np.cumsum(lengths)
    return np.repeat(starts - (past - lengths), lengths) + np.arange(int(past[-1]) if len(past) else 0)


def byte_strings(array: pa.Array) -> list[bytes]:
    """The values of a large_binary array without nulls."""
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, 8 * array.offset).tolist() if len(array) else []
    data = array.buffers()[2].to_pybytes() if array.buffers()[2] else b""
    return [data[a:b] for a, b in pairwise(offsets)]


class WordEncoder:
    """Encodes texts with the tokenizer's library, each distinct piece that is remembered once.

    New pieces go to the library's model many at a time; a piece's ids end
    with the first id whose token carries the word end.  Texts without an
    apostrophe are cut on whole arrays, texts with one by the pattern, and
    texts with other characters or a special token are encoded by the library
    as a whole.  A bounded number of pieces is remembered: when they are too
    many, those met in one call only are forgotten.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.library = Tokenizer.from_file(tokenizer_path)
        self.library.no_padding()
        self.library.no_truncation()
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_end[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]     # printable stand-ins of the bytes
        hidden = [b for b in range(256) if b not in set(shown)]
        stand_in = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.stand_in = [stand_in[b] for b in range(256)]
        self.index: dict[bytes, int] = {}
        self.pool = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)
        self.calls = np.empty(0, np.int32)      # calls that met the piece, halved whenever pieces are forgotten

    def forget(self) -> None:
        """Keep the pieces met in several calls, of these at most half of what is remembered."""
        kept = np.flatnonzero(self.calls > 1)
        if len(kept) > WORD_MEMORY // 2:
            kept = np.sort(kept[np.argsort(-self.calls[kept], kind="stable")[:WORD_MEMORY // 2]])
        pieces = list(self.index)
        self.index = dict(zip(map(pieces.__getitem__, kept.tolist()), range(len(kept))))
        self.sizes, starts = self.sizes[kept], self.starts[kept]
        self.pool = self.pool[spans(starts, self.sizes)]
        self.starts, self.calls = np.cumsum(self.sizes) - self.sizes, self.calls[kept] // 2

    def _learn(self, pieces: list[bytes]) -> None:
        shown = [p.decode() if p.isalnum() else "".join(map(self.stand_in.__getitem__, p)) for p in pieces]
        joined = [" ".join(shown[i:i + 500]) for i in range(0, len(shown), 500)]
        found = self.model.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        sizes = np.diff(np.flatnonzero(self.word_end[ids]) + 1, prepend=0)
        self.index.update(zip(pieces, range(len(self.index), len(self.index) + len(pieces))))
        self.starts = np.concatenate((self.starts, len(self.pool) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.calls = np.concatenate((self.calls, np.zeros(len(pieces), np.int32)))
        self.pool = np.concatenate((self.pool, ids))

    def _entries(self, pieces: pa.Array) -> np.ndarray:
        """Pool entry of every piece; unknown pieces are learned."""
        coded = pieces.dictionary_encode()
        different = byte_strings(coded.dictionary)
        entries = np.fromiter(map(self.index.get, different, repeat(-1)), np.int64, len(different))
        fresh = np.flatnonzero(entries < 0)
        if len(fresh):
            entries[fresh] = len(self.index) + np.arange(len(fresh))
            self._learn([different[i] for i in fresh.tolist()])
        self.calls[entries] += 1
        return entries[coded.indices.to_numpy()]

    def _cut_plain(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """Pieces of lower-cased texts without an apostrophe, and each text's number of pieces."""
        data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        kind = KINDS[data]
        begins = kind != WHITE
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        inside = kind != WHITE
        offsets = np.append(np.cumsum(inside, dtype=np.int32)[begins] - 1, np.count_nonzero(inside)).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                       [None, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes())])
        ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
        return pieces, np.diff(np.cumsum(begins, dtype=np.int32)[ends - 1], prepend=0) if texts else ends

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, each text's number of ids), an end id closing every text."""
        if len(self.index) > WORD_MEMORY:
            self.forget()
        plain, quoted, whole = [], [], []
        for k, text in enumerate(texts):
            odd = UNSAFE.search(text) or any(s in text for s in self.special)
            (whole if odd else quoted if "'" in text else plain).append(k)
        pieces, counts = self._cut_plain([texts[k].lower().encode() for k in plain])
        cut = [[p.encode() for p in PIECES.findall(texts[k].lower())] for k in quoted]
        more = pa.array(list(chain.from_iterable(cut)), pa.large_binary())
        entries = self._entries(pa.chunked_array([pieces, more]).combine_chunks())
        # The end id and whole texts are further entries behind the known pieces, for this call only.
        ids = [np.array(self.library.encode(texts[k], add_special_tokens=False).ids, np.uint32) for k in whole]
        own = np.array([1, *map(len, ids)], np.int64)
        pool = np.concatenate((self.pool, np.array([END_ID], np.uint32), *ids))
        starts = np.concatenate((self.starts, len(self.pool) + np.cumsum(own) - own))
        sizes = np.concatenate((self.sizes, own))
        end = len(self.sizes)
        entries = np.concatenate((entries, end + 1 + np.arange(len(whole))))
        # Back into the texts' order, each text followed by the end id.
        number = np.empty(len(texts), np.int64)
        number[plain + quoted + whole] = np.concatenate((counts, np.array([len(c) for c in cut], np.int64),
                                                         np.ones(len(whole), np.int64)))
        first = np.empty(len(texts), np.int64)
        by_kind = number[plain + quoted + whole]
        first[plain + quoted + whole] = np.cumsum(by_kind) - by_kind
        closed = np.insert(entries[spans(first, number)], np.cumsum(number), end)
        lengths = sizes[closed]
        out = pool[spans(starts[closed], lengths)]
        return out, np.diff(np.cumsum(lengths)[np.cumsum(number + 1) - 1], prepend=0)


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                 shard_ids: int = SHARD_IDS) -> None:
    """Encode every text and write the shards, in ascending id order, to ``path``."""
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = from_worker("word-encoder", tokenizer_path) or WordEncoder(tokenizer_path)
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, pieces, lengths, held = [], [], [], 0

        def close():
            nonlocal seq, held
            blob = build_shard(doc_ids, np.concatenate(pieces), np.concatenate(lengths))
            out = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "n_docs": pa.array([len(doc_ids)], pa.int64()), "n_ids": pa.array([held], pa.int64()),
                "blob": pa.array([blob], pa.binary())})
            seq, held = seq + 1, 0
            doc_ids.clear()
            pieces.clear()
            lengths.clear()
            return out
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = np.unique(np.concatenate(([0], np.flatnonzero(np.diff(size // STEP_BYTES)) + 1, [batch.num_rows])))
            for at, past in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                some = batch.slice(at, past - at)
                ids, sizes = encoder.encode(some.column(1).to_pylist())
                doc_ids += some.column(0).to_pylist()
                pieces.append(ids)
                lengths.append(sizes)
                held += len(ids)
                if held >= shard_ids:
                    yield close()
        if doc_ids:
            yield close()
        to_worker("word-encoder", tokenizer_path, encoder)

    ordered = small_batches(docs).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")) \
        .repartitionByRange(F.col("doc_id").asc_nulls_last()) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_last())
    ordered.mapInArrow(shards, SHARD_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document, decoded: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, blob in zip(batch.column(0), batch.column(1), batch.column(2)):
                rows, at = [], 0
                for doc_id, ids in Shard(blob.as_py()).documents():
                    rows.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                ids, starts, sizes, sums = zip(*rows)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part.as_py()] * len(rows), pa.int32()),
                    "seq": pa.array([seq.as_py()] * len(rows), pa.int32()),
                    "doc_id": pa.array(ids, pa.int64()), "inside": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(sizes, pa.int64()), "ids_crc32": pa.array(sums, pa.int64())})

    stored = spark.read.schema(SHARD_SCHEMA).parquet(path)
    # Ids before a shard: those of earlier ranges, and of earlier shards of its range.
    sizes = stored.select("part", "seq", "n_ids")
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    block = F.floor(F.col("part") / 1024)
    blocks = parts.groupBy(block.alias("block")).agg(F.sum("n").alias("n"))
    earlier_blocks = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier_parts = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    block_start = blocks.select("block", F.coalesce(F.sum("n").over(earlier_blocks), zero).alias("block_start"))
    part_start = parts.withColumn("block", block) \
        .withColumn("part_start", F.coalesce(F.sum("n").over(earlier_parts), zero)) \
        .join(block_start, "block").select("part", (F.col("part_start") + F.col("block_start")).alias("part_start"))
    shard_start = sizes.select("part", "seq", F.coalesce(F.sum("n_ids").over(in_part), zero).alias("shard_start")) \
        .join(part_start, "part")
    rows = small_batches(stored).select("part", "seq", "blob").mapInArrow(
        decode, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(shard_start, ["part", "seq"]).select(
        "doc_id", (F.col("part_start") + F.col("shard_start") + F.col("inside")).alias("start"),
        "n_tokens", "ids_crc32", "part", "seq")


def token_files(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Write the token files of a table and read them back."""
    path = path or new_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer_path, path, id_col, text_col)
    return read_tokens(docs.sparkSession, path)


ship_by_value(__name__)
