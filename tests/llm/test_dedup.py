"""Exact, near and substring deduplication against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from dealsieve.llm import content_sort as C
from dealsieve.llm import sketch_dedup as K
from dealsieve.llm import window_dedup as W
from dealsieve.llm.graph import components

from .helpers import awkward_rows, clashing, frame, prose, words_of


def smallest(ids):
    return min((i for i in ids if i is not None), default=None)


@pytest.mark.parametrize("cell_rows", [1, 2, 500])
def test_content_groups(spark, cell_rows):
    rows = awkward_rows() + [(500 + i, "the same\ttext", "en", "a", 1) for i in range(300)]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    out = C.content_groups(clashing(spark, rows), cell_rows=cell_rows).collect()
    want = Counter((r[0], smallest(groups[norm(r[1])]), len(groups[norm(r[1])]),
                    hashlib.sha256(norm(r[1]).encode()).hexdigest()) for r in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == want
    kept = [r for r in out if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("cell_rows", [1, 500])
def test_exact_dedup_keeps_one_row_of_each_text(spark, cell_rows):
    rows = awkward_rows() + [(500 + i, "the same\ttext", "en", "a", 1) for i in range(300)]
    docs = clashing(spark, rows)
    out = C.exact_dedup(docs, cell_rows=cell_rows)
    assert out.columns == docs.columns
    found = out.collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    assert {norm(r.text): r.doc_id for r in found} == {t: smallest(ids) for t, ids in groups.items()}
    assert len(found) == len(groups)


def shingles(text):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    n = min(5, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def plain_components(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * k >= 85 * (len(sets[i]) + len(sets[j]) - k):
                parent[root(i)] = root(j)
    group = defaultdict(list)
    for i, r in enumerate(rows):
        group[root(i)].append(r[0])
    return Counter((r[0], len(sets[i]), smallest(group[root(i)])) for i, r in enumerate(rows))


def families(seed, n, length):
    """Texts with copies at similarities around the threshold."""
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(5000)]
    for f in range(n):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for _ in range(12):
            own = list(base)
            for _ in range(rng.randint(0, max(1, length // 40))):
                own[rng.randrange(length)] = rng.choice(vocabulary)
            rows.append((len(rows) + 1000, " ".join(own), "en", "a", f))
    return rows


@pytest.mark.parametrize("block", [4, 512])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(K, "BLOCK", block)
    rows = awkward_rows() + families(1, 8, 120) + families(2, 5, 30)
    out = K.near_duplicates(clashing(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == plain_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_near_dedup_keeps_columns_and_one_of_each_group(spark):
    rows = families(3, 5, 100)
    docs = clashing(spark, rows)
    out = K.near_dedup(docs)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {c for _, _, c in plain_components(rows)}


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 4000).astype(np.uint64)
    a, b = np.unique(base[:3000]), np.unique(base[300:3300])
    ra, rb, both = K.sketch([a, b, np.unique(np.concatenate((a, b)))])
    assert (np.maximum(ra, rb) == both).all()
    true = 2700 / 3300
    assert abs((ra == rb).mean() - true) < 5 * (true * (1 - true) / K.REGISTERS) ** 0.5
    assert K.likely_links(ra, rb[None], len(a), np.array([len(b)]))[0]
    far = K.sketch([np.unique(base[1500:])])[0]
    assert not K.likely_links(ra, far[None], len(a), np.array([2500]))[0]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert out == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def plain_windows(rows):
    """Expected (id, words, removed, kept words) of distinct rows, by trying every window."""
    order = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    seen, out = set(), {}
    for null, i, text in order:
        words = words_of(text)
        gone = set()
        for s in range(len(words) - W.WINDOW + 1):
            g = tuple(words[s:s + W.WINDOW])
            if g in seen:
                gone.update(range(s, s + W.WINDOW))
            seen.add(g)
        out[None if null else i, text] = (len(words), len(gone), " ".join(
            w for k, w in enumerate(words) if k not in gone))
    return out


@pytest.mark.parametrize("chunk,bucket", [(2000, 1 << 10), (4 << 20, 3 << 20)])
def test_windows_equal_a_plain_search(spark, monkeypatch, chunk, bucket):
    monkeypatch.setattr(W, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(W, "BUCKET_BYTES", bucket)
    rng = random.Random(5)
    passage = prose(rng, 60)
    rows = awkward_rows()
    rows += [(300 + i, " ".join([prose(rng, rng.randint(0, 30)), passage, prose(rng, rng.randint(0, 30), ["a", "b"])]),
              "en", "a", 1) for i in range(60)]
    rows += [(400 + i, "z " * (15 + 3 * i), "en", "a", 1) for i in range(10)]
    out = W.drop_windows(clashing(spark, [r for r in rows if r[0] is not None])).collect()
    want = plain_windows([r for r in rows if r[0] is not None])
    originals = {r[0]: r[1] for r in rows}
    assert len(out) == sum(r[0] is not None for r in rows)
    for r in out:
        assert (r.n_words, r.n_removed, r.text) == want[r.doc_id, originals[r.doc_id] or ""], r.doc_id


def test_windows_of_null_ids_come_last(spark):
    text = prose(random.Random(2), 50)
    out = W.drop_windows(frame(spark, [(None, text, "en", "a", 1), (5, text, "en", "a", 1)])).collect()
    assert {r.doc_id: r.n_removed for r in out} == {5: 0, None: 50}


def test_packing_round_trip_and_minima():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 2 ** 60, 200).astype(np.uint64)
    for width in (1, 2, 3, 18, 200, 201):
        want = [values[i:i + width].min() for i in range(len(values) - width + 1)]
        assert W.sliding_minima(values, width).tolist() == want


def test_equal_hashes_of_different_windows_are_told_apart(monkeypatch):
    monkeypatch.setattr(W, "sequence_hashes", lambda h, n: np.zeros(max(len(h) - n + 1, 0), np.uint64))
    words = np.array([*range(30), *range(10, 30), *range(30)], np.int64)
    at = np.array([0, 5, 10, 30, 50, 55, 60])
    assert W._not_first(words, at, np.arange(7), 30).tolist() == [False, False, False, True, True, True, True]


def test_empty_tables(spark):
    empty = clashing(spark, awkward_rows()).limit(0)
    assert C.content_groups(empty).count() == 0 and C.exact_dedup(empty).count() == 0
    assert K.near_duplicates(empty).count() == 0 and K.near_dedup(empty).count() == 0
    assert W.drop_windows(empty).count() == 0
