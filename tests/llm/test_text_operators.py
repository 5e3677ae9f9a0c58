"""Quality rules, language mixtures and license templates against plain versions."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealsieve.llm import host_rules as H
from dealsieve.llm import language_mix as L
from dealsieve.llm import license_templates as T

from .helpers import awkward_rows, clashing, frame, words_of


def plain_counts(text):
    words = words_of(text)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {p for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered), len(lines))


def junk_rows():
    rng = random.Random(3)
    return [(2000 + i, " ".join(rng.choice("ab cd é# <ef> ab".split()) for _ in range(rng.randint(0, 90)))
             + "\nsame line\n" * rng.randint(0, 3), "en", rng.choice("xyz"), 1) for i in range(60)]


def test_base_counts_equal_a_plain_version(spark):
    rows = awkward_rows() + junk_rows()
    out = H.judge_documents(clashing(spark, rows)).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines) for r in out)
    assert got == Counter((r[0], *plain_counts(r[1])) for r in rows)
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.host_ok)


def test_bad_hosts_are_rejected_and_small_ones_shrunk(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, "too short", "en", "bad", 1) for i in range(300)] + [(300, good, "en", "bad", 1)]
    rows += [(1000 + 10 * h + i, good, "en", f"host{h}", 1) for h in range(30) for i in range(10)]
    rows += [(5000, "too short", "en", "tiny", 1), (5001, good, "en", None, 1)]
    out = {r.doc_id: r for r in H.judge_documents(frame(spark, rows)).collect()}
    assert not out[300].host_ok and not out[300].base_failed and not out[300].kept
    assert out[5000].host_ok and 0.3 < out[5000].rate_short < 0.9      # one failure is not proof
    assert out[1000].kept and out[5001].kept and out[5001].host is None


def test_shrinking_follows_the_moments(spark):
    counts = spark.createDataFrame(
        [(h, i < k, False, False, False) for h, n, k in (("a", 10, 5), ("b", 20, 2), ("c", 40, 30)) for i in range(n)],
        "_host string, short boolean, repeats boolean, symbols boolean, dup_lines boolean")
    rates = np.array([5 / 10, 2 / 20, 30 / 40])
    m, v = rates.mean(), rates.var()
    s = min(max(m * (1 - m) / v - 1, 1), 1000)
    out = {r._host: r for r in H.host_verdicts(counts).collect()}
    for host, n, k in (("a", 10, 5), ("b", 20, 2), ("c", 40, 30)):
        assert out[host].rate_short == pytest.approx((k + m * s) / (n + s))
        assert out[host].rate_repeats == 0.0


# ---------------------------------------------------------------- languages

def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = L.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = out.count(), out.where("lang = lang_pred").count()
    assert n > 300 and right >= 0.98 * n
    assert out.where("score < 0 or score > 1").count() == 0


def test_predictions_use_the_text_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 300")
    hidden = docs.withColumn("lang", F.when(L.learnable(), F.col("lang")).otherwise(F.lit("zz"))).withColumn("source", F.lit("q"))
    one = {r.doc_id: r.lang_pred for r in L.identify_languages(docs).collect()}
    two = {r.doc_id: r.lang_pred for r in L.identify_languages(hidden).collect()}
    assert one == two and "zz" not in two.values()


def test_mixtures_and_single_languages():
    rng = np.random.default_rng(0)
    model = rng.dirichlet(np.full(L.BINS, 0.05), 3) * 0.999 + 0.001 / L.BINS
    draw = lambda k, n: rng.choice(L.BINS, n, p=model[k] / model[k].sum())
    chosen, shares = L.explain(draw(1, 400), model)
    assert chosen == [1] and shares.tolist() == [1.0]
    chosen, shares = L.explain(np.concatenate((draw(0, 700), draw(2, 300))), model)
    assert chosen == [0, 2] and abs(shares[0] - 0.7) < 0.08


def test_language_edge_cases(spark):
    rows = awkward_rows()
    out = L.identify_languages(clashing(spark, rows)).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0.0 for i in (4, 5, 6, 12))
    kept = L.keep_identified(clashing(spark, rows))
    assert kept.columns == clashing(spark, rows).columns and {4, 5, 6, 12}.isdisjoint(r.doc_id for r in kept.collect())
    empty = clashing(spark, rows).limit(0)
    assert L.identify_languages(empty).count() == 0 and L.keep_identified(empty).count() == 0
    unlabelled = frame(spark, [(1, "some words", None, "a", 1)])
    assert L.identify_languages(unlabelled).first().lang_pred == "und"


# ---------------------------------------------------------------- licenses

def plain_phrases(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+",
                       "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for phrase, label in T.PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(places), min((i for i, _ in places), default=None),
            max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places})))


def license_rows():
    rng = random.Random(9)
    parts = ["GNU General Public License", "Apache-License", "CC BY", "CC", "BY", "MIT\nLicense", "mit license", "é",
             "Licensed under the", "version 2.0", "Knnounce", "gnu general", "cc  by-nc 4.0", "x1", "::"]
    return [(3000 + i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 14))), "en", "a", 1) for i in range(200)]


def test_base_places_equal_a_plain_search(spark):
    rows = awkward_rows() + license_rows()
    out = T.scan_licenses(clashing(spark, rows)).collect()
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out)
    assert got == Counter((r[0], *plain_phrases(r[1])) for r in rows)
    for r in out:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))


def labels(text):
    return T.scan_text(T.lower_words(text), T.Automaton([(b, a) for a, b in T.PHRASES.items()]), T.Automaton(T.TEMPLATES))


def test_templates_accept_optional_and_replaceable_wording_only():
    assert labels("Licensed under the Apache License, Version 2.0.")["labels"] == "apache,apache-2.0"
    assert labels("Licensed under the fine Apache License, Version 2.0.")["labels"] == "apache"
    gpl = "licensed under the GNU General Public License, version 3"
    assert labels(gpl)["labels"] == labels("This work is " + gpl + " or any later version")["labels"] == "gpl,gpl-notice"
    assert labels(gpl.replace("version", "edition"))["labels"] == "gpl"
    assert labels("released under the MIT license")["score"] == 1.0
    assert labels("released under the well known MIT license")["labels"] == "mit,mit-notice"
    assert labels("released under the very well known MIT license")["labels"] == "mit"
    assert labels("nothing here") == {**labels("nothing here"), "labels": "", "score": 0.0, "n_base": 0}


def test_longest_reading_and_markup_errors():
    a = T.Automaton([("t", "a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> <<var;max=2>> d")])
    words = lambda s: [w.encode() for w in s.split()]
    assert a.matches(words("a d")) == [("t", 0, 2)] and a.matches(words("a b c x y d d")) == [("t", 0, 6)]
    assert a.matches(words("a x y z d")) == [] and a.matches(words("z a b d a d")) == [("t", 1, 6), ("t", 4, 6)]
    for wording in ("<<beginOptional>>a<<endOptional>>", "a <<beginOptional>> b", "<<var;max=1>> a"):
        with pytest.raises(ValueError):
            T.Automaton([("t", wording)])


def test_empty_tables(spark):
    empty = clashing(spark, awkward_rows()).limit(0)
    assert H.judge_documents(empty).count() == 0 and T.scan_licenses(empty).count() == 0
