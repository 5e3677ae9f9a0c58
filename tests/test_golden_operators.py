"""Golden rows for the table operators (FIXTURES.md section 2)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from dealsieve.operators import asof, briefs, credit, facts, resolve, scores, validate, valuation, web
from dealsieve.operators.quantiles import exact_quantiles


def ts(s):
    return dt.datetime.fromisoformat(s)


def facts_and_decisions(spark):
    facts_df = spark.createDataFrame(
        [("C1", ts("2020-01-01"), 1, "a"), ("C1", ts("2020-06-01"), 2, "b"), ("C1", ts("2020-06-01"), 3, "c")],
        "company_number string, fact_date timestamp_ntz, k int, v string")
    dec = spark.createDataFrame(
        [("C1", ts(d)) for d in ["2019-12-31", "2020-01-01", "2020-06-01", "2021-01-01"]],
        "company_number string, decision_date timestamp_ntz")
    return facts_df, dec


@pytest.mark.parametrize("strategy", ["join", "scan"])
def test_asof_golden(spark, strategy):
    f, d = facts_and_decisions(spark)
    got = {r.decision_date.date().isoformat(): r.k
           for r in asof.as_of(f, d, tie_keys=["k"], strategy=strategy).collect()}
    assert got == {"2020-01-01": 1, "2020-06-01": 3, "2021-01-01": 3}


def test_decision_rows_keep_duplicates_and_unmatched(spark):
    f, d = facts_and_decisions(spark)
    dup = d.unionByName(d.limit(1))
    out = asof.decision_rows(dup, {"filings": (f, ["k"])})
    assert out.count() == 5
    assert "filings__k" in out.columns and "filings__fact_date" in out.columns


def test_leak_guard_raises(spark):
    bad = spark.createDataFrame([(ts("2020-01-02"), ts("2020-01-01"))],
                                "fact_date timestamp_ntz, decision_date timestamp_ntz")
    with pytest.raises(ValueError, match="1 facts"):
        asof.assert_no_future_facts(bad)
    with pytest.raises(Exception):
        asof.guard_no_future_facts(bad).collect()


def test_join_and_scan_agree_on_driver_data(spark):
    from dealsieve.plans import views as V
    sf = "/root/testdata/sf0.001"
    dec = V.decisions(spark, sf)
    for name, (f, ties) in V.fact_tables(spark, sf).items():
        a = asof.as_of(f, dec, tie_keys=ties, strategy="join")
        b = asof.as_of(f, dec, tie_keys=ties, strategy="scan")
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0, name


def test_widening_golden(spark):
    peers = spark.createDataFrame([("621", 1.0)] * 9 + [("629", 2.0)] * 3, "industry_code string, multiple double")
    targets = spark.createDataFrame([("T1", "621"), ("T2", "625"), ("T3", "700"), ("T4", "62")],
                                    "company_number string, industry_code string")
    got = {r.company_number: (r.code_length_used, r.peer_count)
           for r in valuation.peer_widening(targets, peers).collect()}
    assert got == {"T1": (3, 9), "T2": (2, 12), "T3": (0, 12), "T4": (3, 12)}


def test_quantiles_negative_scaling_golden(spark):
    peers = spark.createDataFrame([("1", m) for m in [1.5, 2.25, 7.0, 9.1, 3.3]], "industry_code string, multiple double")
    targets = spark.createDataFrame([("T", "9", -3.0)], "company_number string, industry_code string, scaling_value double")
    r = valuation.valuation_quantiles(targets, peers).first()
    got = [round(r[f"value_quantile_{q}"], 6) for q in (10, 25, 50, 75, 90)]
    assert got == [-24.78, -21.0, -9.9, -6.75, -5.4] and r.code_length_used == 0 and r.peer_count == 5


def test_exact_quantiles_match_pandas(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(0, 1, 3000), rng.integers(-5, 5, 2000).astype(float), [0.0, -0.0, 1e300, -1e-300]])
    groups = rng.integers(0, 4, len(vals))
    pdf = pd.DataFrame({"g": groups.astype(int), "v": vals})
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = {r.g: [r[f"q{i}"] for i in range(len(probs))]
           for r in exact_quantiles(spark.createDataFrame(pdf), ["g"], "v", probs).collect()}
    for g, grp in pdf.groupby("g"):
        assert got[g] == [grp["v"].quantile(p) for p in probs]


def test_validation_golden(spark):
    rows = [("m", e, 100.0, lo, hi) for e, lo, hi in [(110.0, 95.0, 115.0), (90.0, 85.0, 95.0),
                                                       (130.0, 115.0, 145.0), (100.0, 90.0, 110.0)]]
    est = spark.createDataFrame(rows, "method_name string, estimated_value double, filed_value double, "
                                      "interval_lower double, interval_upper double")
    r = validate.validation_report(est).first()
    assert r.sample_size == 4 and r.mean_error == 7.5 and round(r.error_standard_deviation, 4) == 17.0783
    assert r.worst_case_error == 30.0 and r.bias_direction == "overestimates"
    # The golden values are rounded; the linear rule itself gives 26.999999999999993 for the 95th.
    assert [round(r.error_quantile_5, 9), round(r.error_quantile_25, 9), round(r.error_quantile_50, 9),
            round(r.error_quantile_75, 9), round(r.error_quantile_95, 9)] == [-8.5, -2.5, 5.0, 15.0, 27.0]
    assert r.observed_coverage == 0.5 and r.calibrated is False


def test_cross_check_benchmarks(spark):
    hc = spark.createDataFrame([("A", "I1", 50.0, 9_000_000.0), ("B", "I2", 50.0, 9_000_000.0)],
                               "company_number string, industry_code string, filed_headcount double, "
                               "multiples_revenue_estimate double")
    bench = spark.createDataFrame([("I1", 100_000.0, 1), ("I1", 1.0, 2)],
                                  "industry_code string, revenue_per_employee double, benchmark_order long")
    got = {r.company_number: r for r in scores.revenue_cross_checks(hc, bench).collect()}
    assert got["A"].headcount_revenue_estimate == 5_000_000.0 and got["A"].revenue_usable is True
    assert got["B"].headcount_revenue_estimate is None and got["B"].revenue_usable is False


def test_distress_forms_and_nan(spark):
    bs = spark.createDataFrame([("A", 100.0, 50.0, 20.0, 200.0, 400.0, 1000.0),
                                ("B", 100.0, 50.0, float("nan"), 200.0, 400.0, 1000.0),
                                ("C", 100.0, 50.0, 20.0, 200.0, 400.0, 0.0)],
                               "company_number string, working_capital double, retained_earnings double, ebit double, "
                               "book_value_of_equity double, total_liabilities double, total_assets double")
    got = {r.company_number: (None if r.distress_score is None else round(r.distress_score, 6), r.score_form)
           for r in scores.distress_scores(bs).collect()}
    assert got == {"A": (1.4784, "full"), "B": (1.344, "reduced_no_ebit"), "C": (None, "full")}


def test_award_summary_golden(spark):
    payload = json.dumps({"noticeList": [
        {"item": {"awardedDate": "2023-05-01", "organisationName": "B"}},
        {"awardedDate": "2022-01-01", "organisationName": "A"},
        {"organisationName": "C"},
        {"awardedDate": "2023-02-01"}]})
    docs = spark.createDataFrame([("1", payload)], "company_number string, payload string")
    companies = spark.createDataFrame([("1", "One"), ("2", "Two")], "company_number string, company_name string")
    got = {r.company_number: r for r in facts.award_summary(companies, facts.notices(docs)).collect()}
    assert (got["1"].award_count, got["1"].most_recent_award_date, got["1"].buying_authorities) == \
        (3, "2023-05-01", ["", "A", "B"])
    assert (got["2"].award_count, got["2"].most_recent_award_date, got["2"].buying_authorities) == (0, None, [])


def test_charges_golden(spark):
    payload = json.dumps({"items": [
        {"created_on": "2020-01-01", "status": "outstanding", "classification": {"description": "floating"},
         "persons_entitled": [{"name": "Bank"}, {}], "particulars": {"description": "all assets"}},
        {"created_on": "2021-01-01", "status": "satisfied"}]})
    docs = spark.createDataFrame([("1", payload), ("2", json.dumps({"items": []}))],
                                 "company_number string, payload string")
    rows = sorted(facts.charges(docs).collect(), key=lambda r: r.created_on)
    assert len(rows) == 2 and rows[0].persons_entitled == ["Bank", ""] and rows[1].classification is None


def test_ownership_golden(spark):
    k = facts.CORPORATE_CONTROLLER_KIND
    docs = spark.createDataFrame([("1", json.dumps({"items": [{"name": "Parent", "kind": k},
                                                              {"name": "Ann", "kind": "individual"}]})),
                                  ("2", json.dumps({"items": []}))], "company_number string, payload string")
    got = {r.company_number: (r.corporate_controllers, r.part_of_group) for r in facts.ownership(docs).collect()}
    assert got == {"1": (["Parent"], True), "2": ([], False)}


def test_filing_record_defaults(spark):
    prof = spark.createDataFrame([("1", json.dumps({"company_name": "One", "registered_office_address":
                                                    {"address_line_1": "1 Road", "postal_code": "AB1"}}))],
                                 "company_number string, payload string")
    r = facts.filing_records(prof, prof.limit(0), prof.limit(0)).first()
    assert (r.sic_codes, r.officer_names, r.filing_count, r.registered_postcode) == ([], [], 0, "AB1")


def test_accreditation_golden(spark):
    companies = spark.createDataFrame([("1", "A", "http://a", "<p>we are iso9001 certified</p>"),
                                       ("2", "B", "http://b", "<p>nothing</p>"),
                                       ("3", "C", None, "<p>iso 9001</p>")],
                                      "company_number string, company_name string, website_url string, html string")
    wide = {r.company_number: r for r in web.accreditation_wide(companies).collect()}
    assert set(wide) == {"1", "2"}
    assert wide["1"].iso_9001_status == "claimed on site" and "iso9001" in wide["1"].iso_9001_citation
    assert wide["2"].iso_9001_status == "not found on site" and wide["2"].iso_9001_citation is None
    long = web.accreditation_long(web.accreditation_wide(companies), list(web.ACCREDITATION_TERMS))
    lines = {(r.company_number, r.accreditation): r.statement for r in long.collect()}
    assert lines[("2", "cyber_essentials")] == "cyber essentials: not found on the site, which is not proof it is not held"


def test_review_routing_golden(spark):
    from dealsieve.operators.text_models import review_routing
    df = spark.createDataFrame([("1", "A", 0.59, "A"), ("2", "A", 0.60, "A"), ("3", "A", 0.99, None)],
                               "company_number string, predicted_code string, confidence double, filed_sic_code string")
    got = {r.company_number: (r.needs_review, r.disagrees_with_filed) for r in review_routing(df).collect()}
    assert got == {"1": (True, False), "2": (False, False), "3": (True, True)}


def test_auc_golden(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, s double")
    assert credit.auc_exact(df, "y", "s").first().auc == 0.75
    ties = spark.createDataFrame([(0, 0.5), (0, 0.5), (1, 0.5), (1, 0.5)], "y int, s double")
    assert credit.auc_exact(ties, "y", "s").first().auc == 0.5


def test_auc_matches_brute_force(spark):
    import random
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(600)]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = credit.auc_exact(spark.createDataFrame(rows, "y int, s double"), "y", "s").first().auc
    assert abs(got - brute) < 1e-12


def test_csv_intake_and_briefs(spark):
    header = "company_number,company_name,probability,interval_lower,interval_upper,abstention_status," \
             "top_drivers,comparable_companies,counterfactual_levers"
    lines = [header, "1,One,0.5,0.4,0.6,abstained,d,c,l", "2,Two,0.7", "3,Three,0.5,0.4,0.6,scored,d,\"x,y\",l",
             "4,Four,0.5,0.4,0.6,scored,d,c,"]
    accepted, quarantined = briefs.read_screened(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(r.company_number for r in accepted.collect()) == ["1", "4"]
    assert sorted(r.field_count for r in quarantined.collect()) == [3, 10]
    rendered = {r.company_number: r.brief_text for r in briefs.render_briefs(accepted).collect()}
    assert rendered["1"].startswith("ABSTAINED.") and rendered["4"].startswith("Scored.")
    mailboxes = spark.createDataFrame([("a@x",), ("b@x",)], "recipient string")
    queue = briefs.dispatch_queue(briefs.render_briefs(accepted), mailboxes).collect()
    assert sorted((r.recipient, r.outcome) for r in queue) == [
        ("a@x", "queued"), ("b@x", "queued"), ("none", "skipped_abstained")]
    assert [r.outcome for r in briefs.dispatch_queue(briefs.render_briefs(accepted), mailboxes.limit(0)).collect()] == [
        "skipped_abstained"]


def test_resolution_partition(spark):
    ref = spark.createDataFrame([("R1", "Acme Builders", "P1", None, None), ("R2", "Acme Builder", "P1", None, None),
                                 ("R3", "Northern Steel", None, None, None)],
                                "company_number string, company_name string, postcode string, sic_code string, "
                                "website_url string")
    cands = spark.createDataFrame([(None, "Acme Builders Limited", "P1", "41201", "http://a"),
                                   ("X9", "Passing Through", None, None, None),
                                   ("", "Nothern Steel", None, None, None),
                                   (None, "Zzzz Unknown", None, None, None)],
                                  "company_number string, company_name string, postcode string, sic_code string, "
                                  "website_url string")
    out = resolve.resolve_candidates(cands, ref)
    flags = {r.company_name: (r.outcome, r.matched_number) for r in out["flags"].collect()}
    assert flags["Acme Builders Limited"] == ("resolved", "R1")
    assert flags["Passing Through"][0] == "passed_through"
    assert flags["Nothern Steel"] == ("resolved", "R3")
    assert flags["Zzzz Unknown"] == ("unmatched", None)
    audit = {r.candidate_name: r for r in out["audit"].collect()}
    assert audit["Zzzz Unknown"].score == 0.0 and audit["Zzzz Unknown"].matched_name is None
    assert "Passing Through" not in audit
    resolved = {r.company_number: r for r in out["resolved"].collect()}
    assert resolved["R1"].sic_code == "41201" and resolved["R1"].website_url == "http://a"
    assert out["resolved"].count() + out["unmatched"].count() == cands.count()


def test_rare_token_blocking_is_lossless(spark):
    from dealsieve.functions import names as N
    from dealsieve.plans import views as V
    r = V.name_records(spark, "/root/testdata/sf0.001").select("doc_id", "company_name")
    banded = resolve.candidate_pairs(r, r).where(F.col("doc_id_one") < F.col("doc_id_two"))
    sigs = r.select("doc_id", N.name_signature("company_name").alias("sig"))
    a, b = sigs.alias("a"), sigs.alias("b")
    brute = a.join(b, F.col("a.doc_id") < F.col("b.doc_id")).where(
        N.equal_slots(F.col("a.sig"), F.col("b.sig")) >= 32)
    assert banded.count() == brute.count()


def test_reference_limit_keeps_most_similar(spark):
    ref = spark.createDataFrame([(f"R{i}", "Acme Builders", None, None, None) for i in range(5)]
                                + [("S1", "Acme Builders Group", None, None, None)],
                                "company_number string, company_name string, postcode string, sic_code string, "
                                "website_url string")
    cands = spark.createDataFrame([(None, "Acme Builders", None, None, None)],
                                  "company_number string, company_name string, postcode string, sic_code string, "
                                  "website_url string")
    capped = resolve.resolve_candidates(cands, ref, reference_limit=2)["flags"].first()
    assert (capped.outcome, capped.matched_number) == ("resolved", "R0")   # ties: lowest number
    full = resolve.resolve_candidates(cands, ref)["flags"].first()
    assert full.matched_number == "R0"
    hits = resolve.reference_search(cands.withColumn("k", F.lit(1)), ref, "k", 3).collect()
    assert [(r.company_number, r["rank"]) for r in sorted(hits, key=lambda r: r["rank"])] == [("R0", 1), ("R1", 2), ("R2", 3)]


def record_frame(spark, rows):
    return spark.createDataFrame(rows, "company_number string, company_name string, postcode string, sic_code string, "
                                       "website_url string")


def test_a_name_below_the_signature_gate_is_resolved_by_its_score(spark):
    out = resolve.resolve_candidates(record_frame(spark, [(None, "Smyth Foods", None, None, None)]),
                                     record_frame(spark, [("R1", "Smith Foods", None, None, None)]))["flags"].first()
    assert (out.outcome, out.matched_number) == ("resolved", "R1") and abs(out.score - 20 / 22) < 1e-12


@pytest.mark.parametrize("threshold", [0.82, 0.90, 0.95])
def test_no_pair_at_or_above_the_threshold_is_lost(spark, threshold):
    """Brute force on the score rule: every pair of records, names of all lengths, fields held or not."""
    import difflib
    import random
    rnd = random.Random(3)
    base = ["acme builders", "north west steel works", "ab", "a", "", "aaaa aaaa aaaa", "the long established trading company of the "
            "northern counties and the isle of man", "smith", "xylophone quartz"]

    def variant(name):
        chars = list(name)
        for _ in range(rnd.randint(0, max(1, len(chars) // 8))):
            kind, at = rnd.randint(0, 2), rnd.randint(0, max(len(chars) - 1, 0))
            if kind == 0 and chars:
                chars.pop(min(at, len(chars) - 1))
            elif kind == 1:
                chars.insert(at, rnd.choice("abcxyz "))
            elif chars:
                chars[min(at, len(chars) - 1)] = rnd.choice("abcxyz")
        return "".join(chars)

    def records(n):
        return [(f"R{i}", variant(rnd.choice(base)), rnd.choice([None, "", "P1", "P2"]), rnd.choice([None, "1", "2"]), None)
                for i in range(n)]
    left, right = records(90), records(90)
    norm = lambda s: " ".join(w for w in "".join(c for c in s.lower() if c.isalnum() or c == " ").split())
    want = set()
    for a in left:
        for b in right:
            ratio = difflib.SequenceMatcher(None, norm(a[1]), norm(b[1])).ratio()
            held = [(x, y, 0.2) for x, y in ((a[2], b[2]), (a[3], b[3])) if x and y]
            score = (0.6 * ratio + sum(w for x, y, w in held if x == y)) / (0.6 + sum(w for _, _, w in held))
            if score >= threshold:
                want.add((norm(a[1]), a[2] or None, a[3], norm(b[1]), b[2] or None, b[3]))
    found = resolve.score_pairs(resolve.record_classes(record_frame(spark, left)),
                                resolve.record_classes(record_frame(spark, right)), threshold)
    got = {tuple(r)[:6] for r in found.where(F.col("score") >= threshold).collect()}
    assert got == want and len(want) > 100


def test_a_name_held_by_many_records_is_scored_once(spark):
    ref = record_frame(spark, [(f"R{i:03d}", "Common Name", "P1", "1", None) for i in range(200)])
    cands = record_frame(spark, [(None, "Common Name Ltd", "P1", "1", str(i)) for i in range(50)])
    pairs = resolve.score_pairs(resolve.record_classes(cands), resolve.record_classes(ref))
    assert pairs.count() == 1
    out = resolve.resolve_candidates(cands, ref)["flags"]
    assert out.count() == 50 and {r.matched_number for r in out.collect()} == {"R000"}


def test_thresholds_without_complete_blocking_are_refused(spark):
    classes = resolve.record_classes(record_frame(spark, [("1", "A", None, None, None)]))
    with pytest.raises(ValueError):
        resolve.score_pairs(classes, classes, 0.80)


def test_names_of_a_block_meet_by_length_and_letters(spark, tmp_dir):
    """One block of 1,500 names: hardly more pairs are scored than match, and growth follows the matches."""
    import random
    rnd = random.Random(5)
    sound = ["ba", "ke", "lo", "mi", "nu", "ra", "se", "to", "vi", "zu", " "]

    def scored(n):
        names = ["".join(rnd.choice(sound) for _ in range(rnd.randint(4, 40))).strip() for _ in range(n)]
        rows = [(f"R{i}", x, "P1", "1", None) for i, x in enumerate(names)]
        near = [(f"N{i}", x + "a", "P1", "1", None) for i, x in enumerate(names[:n // 10])]
        out = resolve.score_pairs(resolve.record_classes(record_frame(spark, near)),
                                  resolve.record_classes(record_frame(spark, rows)))
        assert out.where("score >= 0.9").count() >= n // 10 - 1
        return out.count()
    few, many = scored(500), scored(1500)
    assert many < 150 * 1500 / 20 and few > 0


def test_awards_as_of_counts_only_known_awards(spark):
    notices = spark.createDataFrame([("1", "2024-01-01T00:00:00", "A"), ("1", "2024-02-01T00:00:00", "B"),
                                     ("1", None, "C"), ("2", "2024-03-01T00:00:00", "D")],
                                    "company_number string, awardedDate string, organisationName string")
    dec = spark.createDataFrame([("1", ts("2023-12-31")), ("1", ts("2024-01-15")), ("1", ts("2024-06-01")),
                                 ("3", ts("2024-06-01"))], "company_number string, decision_date timestamp_ntz")
    got = {(r.company_number, r.decision_date.date().isoformat()): (r.award_count, r.latest_award_at)
           for r in facts.awards_as_of(notices, dec).collect()}
    assert got[("1", "2023-12-31")] == (0, None)
    assert got[("1", "2024-01-15")] == (1, ts("2024-01-01"))
    assert got[("1", "2024-06-01")] == (2, ts("2024-02-01"))
    assert got[("3", "2024-06-01")] == (0, None)


def test_asof_strategies_match_brute_force_on_a_hot_company(spark):
    import random
    rnd = random.Random(5)
    base = dt.datetime(2020, 1, 1)
    facts_rows = [("HOT", base + dt.timedelta(days=rnd.randint(0, 150), seconds=rnd.randint(0, 86399)), i, float(i))
                  for i in range(400)]
    facts_rows += [("HOT", facts_rows[0][1], 1000, 0.5)]          # a tie on the timestamp
    dec_rows = [("HOT", base + dt.timedelta(days=d)) for d in (-5, 0, 31, 45, 60, 200)] + [("NONE", base)]
    f = spark.createDataFrame(facts_rows, "company_number string, fact_date timestamp_ntz, k int, v double")
    d = spark.createDataFrame(dec_rows, "company_number string, decision_date timestamp_ntz")
    expected = {}
    for c, when in dec_rows:
        known = [r for r in facts_rows if r[0] == c and r[1] <= when]
        if known:
            expected[(c, when)] = max(known, key=lambda r: (r[1], r[2]))[2]
    for strategy in ("join", "scan"):
        got = {(r.company_number, r.decision_date): r.k
               for r in asof.as_of(f, d, tie_keys=["k"], strategy=strategy).collect()}
        assert got == expected, strategy


def test_awards_as_of_reads_every_accepted_form(spark):
    dates = ["2023-05-01", "2023-05-01T00:00:00Z", "2023-05-01T00:00:00+01:00", "2023-05-01T00:00:00", "soon", ""]
    notices = spark.createDataFrame([("1", d, "A") for d in dates], "company_number string, awardedDate string, organisationName string")
    dec = spark.createDataFrame([("1", ts("2023-05-01")), ("1", ts("2023-04-30T23:30:00"))],
                                "company_number string, decision_date timestamp_ntz")
    got = {r.decision_date: r.award_count for r in facts.awards_as_of(notices, dec).collect()}
    assert got == {ts("2023-05-01"): 4, ts("2023-04-30T23:30:00"): 1}
    assert [r.awardedDate for r in facts.undated_awards(notices).collect()] == ["soon"]


def test_unreadable_documents_give_no_facts(spark):
    from dealsieve import schemas as S
    docs = spark.createDataFrame([("1", '{"items":[{"name":"Par'), ("2", None), ("3", "{}"), ("4", "[]")],
                                 "company_number string, payload string")
    assert [(r.company_number, r.part_of_group) for r in facts.ownership(docs).collect()] == [("3", False)]
    assert facts.charges(docs).count() == 0
    assert [r.company_number for r in facts.filing_records(docs).collect()] == ["3"]
    assert {r.company_number for r in facts.unreadable(docs, S.CONTROLLERS_PAYLOAD).collect()} == {"1", "2", "4"}


def test_two_valuations_of_one_company_stay_apart(spark):
    peers = spark.createDataFrame([(c, m) for c in ("111", "222") for m in [1.0] * 4 + [5.0] * 4], "industry_code string, multiple double")
    targets = spark.createDataFrame([("C", "111", 2.0), ("C", "222", 10.0), ("C", "222", 10.0)],
                                    "company_number string, industry_code string, scaling_value double")
    rows = valuation.valuation_quantiles(targets, peers).collect()
    assert sorted(r.value_quantile_50 for r in rows) == [6.0, 30.0, 30.0]
    assert valuation.value_distribution(targets, peers).count() == 24
    asked = spark.createDataFrame([("D",)], "company_number string")
    assert valuation.value_distribution(targets, peers, requested=asked).count() == 0
    keys = valuation.key_multiples(valuation.widened(targets, peers), peers)
    assert keys.count() == 16


def test_items_without_a_number_are_never_near(spark):
    from dealsieve.operators import similar
    items = spark.createDataFrame([(1, 1.0, "a"), (2, None, "a"), (3, 2.0, "a"), (4, float("nan"), "a"), (5, 9.0, "a")],
                                  "id long, size double, kind string")
    got = similar.nearest(items, items.where("id = 1"), "id", ["size"], ["kind"], 3).collect()
    assert sorted((r["rank"], r.item_id) for r in got) == [(1, 3), (2, 5)]


def test_quantiles_with_infinities_and_null_groups(spark):
    inf = float("inf")
    df = spark.createDataFrame([("a", v) for v in (-inf, -1.0, 0.0, 3.0, inf, float("nan"), None)] + [(None, 2.0), ("b", inf)],
                               "g string, v double")
    got = {r.g: (r.n, r.q0, r.q1, r.q2) for r in exact_quantiles(df, ["g"], "v", [0.0, 0.5, 1.0]).collect()}
    assert got == {"a": (5, -inf, 0.0, inf), None: (1, 2.0, 2.0, 2.0), "b": (1, inf, inf, inf)}


@pytest.mark.parametrize("scale", [1e-9, 1e6, -40.0])
def test_auc_of_scores_of_any_range(spark, scale):
    import random
    rnd = random.Random(4)
    rows = [(rnd.randint(0, 1), rnd.choice([-0.0, 0.0, rnd.random() - 0.3, 0.25]) * scale) for _ in range(400)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = credit.auc_exact(spark.createDataFrame(rows, "y int, s double"), "y", "s").first().auc
    assert abs(got - brute) < 1e-12


def test_text_lift_leaves_out_incomplete_rows(spark):
    import random
    rnd = random.Random(1)
    rows = [(i, rnd.random(), rnd.random(), rnd.random(), rnd.randint(0, 1), rnd.randint(0, 1), rnd.randint(0, 1)) for i in range(300)]
    rows += [(300, None, 0.1, 0.1, 0, 0, 1), (301, float("nan"), 0.1, 0.1, 0, 0, 0), (302, 0.1, 0.1, 0.1, 0, 0, None)]
    df = spark.createDataFrame(rows, "k long, current_ratio double, gearing double, retained_earnings_to_assets double, "
                                     "report_negative_language_flag int, going_concern_flag int, defaulted_within_year int")
    r = credit.text_feature_lift(df, "k").first()
    assert (r.rows_used, r.rows_left_out) == (300, 3)
    assert abs(r.text_feature_lift - (r.with_text_auc - r.ratio_only_auc)) < 1e-12


def test_vocabulary_does_not_depend_on_the_partitioning(spark):
    from dealsieve.operators import text_models as TM
    docs = spark.createDataFrame([(f"zeta alpha beta w{i:03d} w{i:03d}",) for i in range(50)], "t string")
    one = TM.vocabulary(docs.coalesce(1), "t", 20)
    assert one == TM.vocabulary(docs.repartition(7), "t", 20) == ["alpha", "beta", "zeta"] + [f"w{i:03d}" for i in range(17)]


def test_absent_modules_keep_their_types(spark):
    from dealsieve.operators import coverage
    companies = spark.createDataFrame([("1", "A"), ("2", "B")], "company_number string, company_name string")
    ran = spark.createDataFrame([("1", 5), ("9", 7)], "company_number string, n int")
    out = coverage.dossier(companies, {"x": (ran, {"n": "bigint"}), "y": (None, {"v": "double"})})
    assert dict(out.dtypes)["n"] == "bigint" and dict(out.dtypes)["v"] == "double"
    assert {r.company_number: (r.x_state, r.n, r.y_state) for r in out.collect()} == {
        "1": ("present", 5, "not run"), "2": ("no record", None, "not run")}
    got = {r.module: tuple(r)[1:] for r in coverage.signal_coverage(companies, {"x": ran, "y": None}).collect()}
    assert got == {"x": (2, 1, 0.5), "y": (None, None, 1.0)}
    assert coverage.select_company_rows(ran, "9", "A").first().n == 7
    assert coverage.select_company_rows(companies.select("company_name"), "9", "B").count() == 1
    assert coverage.select_company_rows(ran.select("n"), "9", "B") is None
