"""A document's text is parsed once, whatever is asked of the parsed document."""

import pytest

from dealsieve.operators import facts

PROFILE = '{"company_name": "A", "sic_codes": ["1"]}'
CONTROLLER = '{"items": [{"name": "A", "kind": "corporate-entity-person-with-significant-control"}]}'
CHARGE = '{"items": [{"created_on": "2020-01-01"}, {"created_on": "2021-01-01"}]}'
NOTICE = '{"noticeList": [{"item": {"awardedDate": "2020-01-01"}}]}'


@pytest.mark.parametrize("flatten, payload, rows", [
    (facts.filing_records, PROFILE, 1), (facts.ownership, CONTROLLER, 1), (facts.charges, CHARGE, 2),
    (facts.notices, NOTICE, 1)])
def test_text_is_parsed_once(spark, flatten, payload, rows):
    docs = spark.createDataFrame(
        [("1", payload), ("2", payload), ("2", payload), (None, payload), ("3", payload[:-9]), ("4", None), ("5", ""),
         ("6", "[]"), ("7", f"  {payload}"), ("8", "null"), ("9", '{"items": 5, "noticeList": 5, "sic_codes": 5}')],
        "company_number string, payload string").repartition(2)
    out = flatten(docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    found = sorted(str(r.company_number) for r in out.collect())
    assert found == sorted(["1", "2", "2", "None", "7"] * rows)
