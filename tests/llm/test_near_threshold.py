"""Near-duplicates at thresholds other than op2's, against all pairs."""

from collections import defaultdict

import corpus_pipeline as P

from dealsieve.llm import sketch_dedup as K

from .helpers import clashing
from .test_dedup import families, shingles, smallest


def components_at(rows, part, whole):
    """Component of every row by trying all pairs."""
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and sets[j] and whole * k >= part * (len(sets[i]) + len(sets[j]) - k):
                parent[root(i)] = root(j)
    group = defaultdict(list)
    for i, r in enumerate(rows):
        group[root(i)].append(r[0])
    return {r[0]: smallest(group[root(i)]) for i, r in enumerate(rows)}


def test_bands_and_floor_follow_the_threshold():
    assert K.banding((85, 100)) == (32, 6) and K.banding((80, 100)) == (38, 5)
    assert abs(K.floor((85, 100)) - (0.85 - 5 * (0.85 * 0.15 / 192) ** 0.5)) < 1e-12
    assert (1 - 0.8 ** 5) ** 38 < K.BAND_MISS


def test_pipeline_stage_links_from_four_fifths(spark):
    # Two texts of 60 words that differ in one inner word share 51 of 61 shingles: 0.836.
    rows = families(7, 6, 60) + [(r[0] + 5000, *r[1:]) for r in families(8, 4, 200)]
    want = components_at(rows, 80, 100)
    assert set(want.values()) != set(components_at(rows, 85, 100).values())
    stage = dict(P.STAGES)["sketch_dedup"]
    assert {r.doc_id for r in stage(spark, clashing(spark, rows), None).collect()} == set(want.values())
    out = K.near_duplicates(clashing(spark, rows), threshold=(80, 100)).collect()
    assert {r.doc_id: r.component_id for r in out} == want
