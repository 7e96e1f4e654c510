"""Every query with an oracle SQL equals DuckDB on sf0.001 (the driver checks sf0.01)."""

import pytest

from oracle_check import compare

import __spark_entry__ as E

NAMES = sorted(E.oracle_sql())


def test_catalog_shape():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 75
    # the corpus queries come all together, or not at all where their folders are missing
    corpus = {n.split("_")[0] for n in q if n.startswith("op") and n[2:3].isdigit()} | {n for n in q if n == "pipeline"}
    assert corpus in (set(), {"pipeline", *(f"op{i}" for i in range(1, 11))})


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, name):
    from conftest import SF_SMALL
    res = compare(spark, SF_SMALL, [name])
    assert res[name][0] == "OK", res[name]


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4
    assert df.columns == ["bmi_category", "n_patients", "mean_combined_risk", "mean_medical_risk",
                          "mean_metabolic", "prevalence"]
