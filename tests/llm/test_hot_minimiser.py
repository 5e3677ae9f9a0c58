"""One minimiser in many different contexts is spread over buckets, with the same result."""

import random
from collections import Counter

import numpy as np

from dealsieve.llm import window_dedup as W
from dealsieve.llm.hashing import sequence_hashes, word_hashes

from .helpers import frame
from .test_dedup import plain_windows


def template_rows(n):
    """Texts with the same three words of a very low hash, other words around them, and some copied windows."""
    rng = random.Random(3)
    words = [f"t{i}" for i in range(90_000)]
    hashes = sequence_hashes(word_hashes([w.encode() for w in words]), W.MINI)
    at = int(np.argmin(hashes))
    line = words[at:at + W.MINI]
    own = lambda k: [f"o{rng.randrange(10 ** 6)}" for _ in range(k)]      # noqa: E731
    same = own(12) + line + own(12)
    return [(i, " ".join(own(20) + (same if i % 10 == 0 else own(18) + line + own(18)) + own(20)), "en", "a", 1)
            for i in range(n)]


def test_a_hot_minimiser_is_split(spark, monkeypatch):
    monkeypatch.setattr(W, "CHUNK_BYTES", 1 << 13)
    monkeypatch.setattr(W, "BUCKET_BYTES", 1 << 13)
    rows = template_rows(400)
    docs = frame(spark, rows)
    load = Counter()
    for r in W.dealt_windows(docs).collect():
        load[r.bucket] += len(W.unpack(r.packed)[5])
    assert max(load.values()) < 4 * sum(load.values()) / len(load)
    want = plain_windows(rows)
    for r in W.drop_windows(docs).collect():
        assert (r.n_words, r.n_removed, r.text) == want[r.doc_id, rows[r.doc_id][1]]
    assert sum(n for _, n, _ in want.values()) > 0


def test_a_chunk_costs_the_same_for_any_number_of_buckets():
    import time
    rows = template_rows(3000)
    texts = [r[1].encode() for r in rows]
    docs = W.Documents(np.zeros(len(rows), bool), np.array([r[0] for r in rows]), np.arange(len(rows)))
    kept, took = {}, {}
    for buckets in (16, 100_000, 3_500_000, 16):
        start = time.process_time()
        out = list(W.super_kmers(texts, docs, buckets))
        took[buckets] = time.process_time() - start
        assert [b for b, _ in out] == sorted({b for b, _ in out}) and out[-1][0] < buckets
        kept[buckets] = sum(len(W.unpack(p)[1]) for _, p in out)
    assert len(set(kept.values())) == 1
    # More buckets are more blobs to compress, never more than one for each string; empty buckets cost nothing.
    assert took[3_500_000] < 2 * took[100_000] + 1


def test_the_map_of_hot_minimisers_does_not_grow(spark, monkeypatch):
    monkeypatch.setattr(W, "CHUNK_BYTES", 1 << 13)
    rows = frame(spark, template_rows(200)).selectExpr("doc_id", "xxhash64(text) AS text_hash", "text")
    few, many = (W.hot_minimisers(rows, 100_000, size) for size in (1 << 13, 1))
    assert len(few) == len(many) == 1 << W.HOT_BITS and 0 < few.sum() < many.sum()
