"""Slot sharding and Poisson mixing against plain versions."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest

from dealsieve.llm import poisson_mix as P
from dealsieve.llm import slot_shards as S

from .helpers import awkward_rows, clashing, frame


def test_shards_are_complete_gapless_and_near_equal(spark):
    rows = awkward_rows() + [(1000 + i, "word " * (i % 7 + 1), "en", "a", 1) for i in range(600)]
    out = S.shard_documents(clashing(spark, rows), 8, rebalance_to=9).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == want
    slots, sizes = defaultdict(list), Counter()
    for r in out:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(8))
    by_slot = Counter()
    for r in out:
        by_slot[r.virtual_slot] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= max(by_slot.values())
    assert all(r.rebalanced_shard in range(9) for r in out)
    assert len({(r.virtual_slot, r.shard, r.rebalanced_shard) for r in out}) == len(by_slot)


def test_slots_do_not_depend_on_the_other_rows(spark):
    rows = awkward_rows()
    one = {r.doc_id: r.virtual_slot for r in S.slot_rows(frame(spark, rows[:20])).collect() if r.doc_id is not None}
    two = {r.doc_id: r.virtual_slot for r in S.slot_rows(frame(spark, rows)).collect() if r.doc_id is not None}
    assert all(two[k] == v for k, v in one.items())


def test_edits_move_little_and_settle():
    sizes = {k: (k * 37) % 101 + 1 for k in range(S.SLOTS)}
    first = S.first_map(sizes, 8)
    assert S.edited_map(first, sizes, 8) == first
    grown = S.edited_map(first, sizes, 9)
    moved = [k for k in first if first[k] != grown[k]]
    assert all(grown[k] == 8 for k in moved) and len(moved) < S.SLOTS / 6
    shrunk = S.edited_map(grown, sizes, 8)
    assert set(shrunk.values()) == set(range(8))
    loads = Counter()
    for k, s in grown.items():
        loads[s] += sizes[k]
    assert max(loads.values()) <= 1.03 * min(loads.values())


def test_map_versions_stay(spark, tmp_dir):
    store = S.SlotMap(spark, f"{tmp_dir}/map")
    one = S.first_map({}, 2)
    store.store(one, {}, 1)
    store.store(S.edited_map(one, {}, 3), {}, 2)
    assert {r.virtual_slot: r.shard for r in store.load(1).collect()} == one
    with pytest.raises(Exception):
        store.store(one, {}, 1)


def test_empty_tables(spark):
    empty = frame(spark, awkward_rows()).limit(0)
    assert S.shard_documents(empty, 8, rebalance_to=9).count() == 0
    assert P.replicate(empty, details=True).count() == 0


def plain_count(key, seed, rate):
    parts, total = max(math.ceil(rate / 8.0), 1), 0
    for j in range(1, parts + 1):
        u = int(hashlib.md5(f"{key}:{seed}:{j}".encode()).hexdigest()[:13], 16) / 2.0 ** 52
        p = c = math.exp(-rate / parts)
        k = 0
        while u >= c and k < 64:
            k += 1
            p *= rate / parts / k
            c += p
        total += k
    return total


@pytest.mark.parametrize("shares", [None, {"a": 5.0, "b": 1.0}])
def test_counts_equal_a_plain_inversion(spark, shares):
    rows = awkward_rows()
    docs = clashing(spark, rows)
    out = P.replicate(docs, shares, details=True).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len((r[1] or "").encode())
    weight = {s: math.sqrt(b) for s, b in size.items()} if shares is None else {s: shares.get(s, 0.0) for s in size}
    rate = {s: weight[s] / sum(weight.values()) * sum(size.values()) / b if b else 1.0 for s, b in size.items()}
    want = Counter()
    for r in rows:
        key = str(r[0]) if r[0] is not None else (r[1] or "")
        want[r[:2]] += plain_count(key, 1, rate[r[3]]) if rate[r[3]] > 0 else 0
    got = Counter((r.doc_id, r.text) for r in out)
    assert got == +want
    assert P.replicate(docs, shares).columns == docs.columns


def test_mean_rates_are_met_and_high_rates_split(spark):
    rows = [(i, "x" * 10, "en", "big" if i % 10 else "small", 1) for i in range(4000)]
    out = P.replicate(frame(spark, rows), {"big": 0.1, "small": 0.9}, details=True)
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["small"] - 3600) < 5 * 60 and abs(n["big"] - 400) < 5 * 20
    assert out.where("source = 'small'").first().rate == pytest.approx(9.0)
    keys = [r.mix_key for r in out.collect()]
    assert len(set(keys)) == len(keys)
