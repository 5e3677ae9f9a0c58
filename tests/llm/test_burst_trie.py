"""The conversation trie against a plain one, with containers of several sizes."""

import hashlib
import random

import pytest

from dealsieve.llm import burst_trie as K

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(convs):
    """Nodes from a dict of conv_id -> list of (role, text), by trying every prefix."""
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {p: [] for p in members}
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def sums(p):
        below = [sums(q) for q in children[p]]
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        return sum(b[0] for b in below) or 1, own + sum(b[1] for b in below)
    out = []
    for p, m in members.items():
        leaves, saved = sums(p)
        joined = ",".join(map(str, sorted(ends.get(p, []))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves, saved,
                    hashlib.sha256(joined.encode()).hexdigest()))
    return sorted(out, key=str)


def sequences_of(rows):
    """conv_id -> ordered turns, ties of the turn number by turn id."""
    def turn_id(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
    out = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            out.setdefault(c, []).append((t is not None, t or 0, turn_id(role, text), role, text))
    return {c: [(r, x) for *_, r, x in sorted(v)] for c, v in out.items()}


def awkward(seed=0, n=60):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        turns = [rng.choice("ab") for _ in range(rng.choice([0, 1, 2, 3, 5]))]
        rows += [(c, i, ("user", "assistant")[i % 2], x * 3) for i, x in enumerate(turns)]
    rows += [(1000 + c, i, "user", f"shared {i}") for c in range(40) for i in range(30)]                     # copies
    rows += [(2000 + c, i, "user", f"shared {i}" if i < 10 + c else f"own {c}") for c in range(15) for i in range(30)]
    rows += [(3000, i, "user", f"long {i % 7} é") for i in range(700)]                                       # one long conversation
    rows += [(3001, i, "user", f"long {i % 7} é") for i in range(650)]
    rows += [(4000, None, "user", "first"), (4000, 0, None, None), (4000, 0, "user", ""), (4001, None, "user", "first"),
             (-7, 1, "user", "aaa"), (None, 1, "user", "nobody's"), (4002, 1, "a", "bc"), (4003, 1, "ab", "c")]
    rows += [(4004, 1, "user", "same"), (4004, 1, "user", "same")]
    return rows


def nodes(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("limit", [1, 40, 1024, 100_000])
def test_equals_plain_trie(spark, monkeypatch, limit):
    monkeypatch.setattr(K, "CONTAINER_TURNS", limit)
    rows = awkward() if limit > 1 else [r for r in awkward() if (r[0] or 0) < 1000 or r[0] >= 4000]
    want = plain_trie(sequences_of(rows))
    assert nodes(K.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(3))) == want


def test_pieces_of_a_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(K, "PIECE_IDS", 7)
    rows = [(c, i, "user", f"t{i}") for c in range(500) for i in range(2)] + [(900, 0, "user", "t0")]
    assert nodes(K.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == plain_trie(sequences_of(rows))


def test_turnless_members_and_empty_table(spark):
    rows = [(5, 0, "user", "x"), (6, 0, "user", "y")]
    placed = K.number_turns(K.turn_rows(spark.createDataFrame(rows, SCHEMA)))
    members = spark.createDataFrame([(5,), (6,), (3,), (9,)], "conv_id long")
    assert nodes(K.build_trie(placed, members)) == plain_trie({**sequences_of(rows), 3: [], 9: []})
    assert nodes(K.build_trie(placed.limit(0), members)) == plain_trie({5: [], 6: [], 3: [], 9: []})
    empty = K.conversation_trie(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and [f"{c} {t.replace('bigint', 'long')}" for c, t in empty.dtypes] == K.NODE.split(", ")


def test_clashing_names_and_texts(spark):
    rows = awkward(3, 20)[:80]
    wide = spark.createDataFrame([(*r, 1, "x", 2, "s") for r in rows], SCHEMA + ", place int, turn_id string, n int, box string")
    out = K.conversation_trie(wide)
    assert nodes(out) == plain_trie(sequences_of(rows))
    turns = [(c, i + 1, *t) for c, v in sequences_of(rows).items() for i, t in enumerate(v)]
    told = K.with_texts(out, spark.createDataFrame(turns, "conv_id long, place long, role string, text string")).collect()
    of = sequences_of(rows)
    assert all((r.role, r.text) == (of[r.conv_id][r.depth - 1] if r.depth else (None, None)) for r in told)


def test_rounds_follow_branchings_not_turns(spark, monkeypatch):
    """Two conversations that agree for 600 turns burst twice: the shared path, then each tail."""
    monkeypatch.setattr(K, "CONTAINER_TURNS", 50)
    calls = []
    paths = K._paths
    monkeypatch.setattr(K, "_paths", lambda *a: calls.append(1) or paths(*a))
    rows = [(c, i, "user", f"t{i}" if i < 600 else f"t{i} of {c}") for c in (1, 2) for i in range(700)]
    assert nodes(K.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == plain_trie(sequences_of(rows))
    assert len(calls) == 2


def test_arrow_batches_and_ranges_do_not_change_places(spark):
    """Conversations that end with a batch, go on over several, or begin in an earlier range."""
    rows = [(c, i, "user", f"t{i % 5}") for c in range(40) for i in range((0, 1, 4, 8, 90)[c % 5])]
    want = plain_trie(sequences_of(rows))
    key, n = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for size in (1, 8, 64):
            spark.conf.set(key, size)
            placed = K.number_turns(K.turn_rows(spark.createDataFrame(rows, SCHEMA).repartition(3)))
            got = {}
            for r in placed.collect():
                got.setdefault(r.conv_id, []).append(r.place)
            assert {c: sorted(v) for c, v in got.items()} == {c: list(range(1, len(v) + 1)) for c, v in sequences_of(rows).items()}
        assert nodes(K.build_trie(placed, placed.select("conv_id"))) == want
    finally:
        spark.conf.set(key, n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
