"""A planted mixture of good and bad hosts."""

import random

from dealsieve.llm import host_rules as H

from .helpers import frame, prose


def planted(seed=1):
    """30 good hosts (8 % junk), 3 bad ones (60 % junk lines), 40 tiny ones with one junk document each."""
    rng = random.Random(seed)
    rows = []

    def host(name, n, junk):
        for _ in range(n):
            words = prose(rng, 60, [f"w{i}" for i in range(900)]).replace("\n", " ")
            if rng.random() < junk:
                words += "\n" + "buy now today\n" * 3       # repeated lines; not a base failure
            rows.append((len(rows), words, "en", name, 1))
    for h in range(30):
        host(f"good{h}", rng.randint(20, 60), 0.08)
    for h in range(3):
        host(f"bad{h}", 60, 0.6)
    for h in range(40):
        host(f"tiny{h}", 1, 1.0 if h % 8 == 0 else 0.0)
    return rows


def test_bad_hosts_go_and_small_or_usual_ones_stay(spark):
    out = H.judge_documents(frame(spark, planted())).collect()
    verdict = {r.host: r.host_ok for r in out}
    assert {h for h, ok in verdict.items() if not ok} == {"bad0", "bad1", "bad2"}
    differs = [r for r in out if r.kept != (not r.base_failed)]
    assert len(differs) == 180 and {r.host[:3] for r in differs} == {"bad"}


def test_hosts_that_all_fail_alike_are_not_singled_out(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, 60).replace("\n", " ") + ("\n" + "again and again\n" * 3 if rng.random() < 0.1 else ""), "en",
             f"h{i % 20}", 1) for i in range(1000)]
    assert all(r.host_ok for r in H.judge_documents(frame(spark, rows)).collect())
