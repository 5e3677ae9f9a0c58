"""Every training-data query with SQL equals it at sf0.01; the others run over the whole table."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import __spark_entry__ as E  # noqa: E402
from dealsieve.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    from oracle_check import compare
    assert compare(spark, SF, [name], verbose=False)[name][0] == "match"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_every_document(spark, name):
    assert E.queries()[name](spark, SF).select("doc_id").distinct().count() == 1000


def test_thirteen_operators_and_the_pipeline_are_registered():
    names = E.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
