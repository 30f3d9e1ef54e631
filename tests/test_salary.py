"""Golden cases for the salary parser, both variants."""

import pytest

from jobtide import functions as J

M = 1.0e6
# input, (low, high, avg, unit) production, avg of the "million only if marked" variant
GOLDEN = [
    ("25 Tr - 35 Tr VND", (25 * M, 35 * M, 30 * M, "VND"), 30 * M),
    ("$1,000 - $2,000 /tháng", (1000.0, 2000.0, 1500.0, "USD"), 1500.0),
    ("Trên 20 triệu", (20 * M, None, 20 * M, "VND"), 20 * M),
    ("Dưới 10 triệu", (None, 10 * M, 10 * M, "VND"), 10 * M),
    ("15 Tr VND", (15 * M, 15 * M, 15 * M, "VND"), 15 * M),
    ("Tới 1.5 triệu", (1 * M, 5 * M, 3 * M, "VND"), 3 * M),
    ("20,000,000 VND", (2e13, 2e13, 2e13, "VND"), 2e7),
    ("hoa hồng", (None, None, None, "VND"), None),
    ("Thương lượng", (None, None, None, None), None),
    (None, (None, None, None, None), None),
    ("", (None, None, None, None), None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "i int, s string")
    p = J.with_salary_columns(df, "s")
    v = J.with_salary_columns(p, "s", True, ("vlow", "vhigh", "vavg", "vunit"))
    return v.select("i", "low", "high", "avg", "unit", "vavg").orderBy("i").collect()


@pytest.mark.parametrize("i", range(len(GOLDEN)))
def test_production_rule(parsed, i):
    assert tuple(parsed[i])[1:5] == GOLDEN[i][1], GOLDEN[i][0]


@pytest.mark.parametrize("i", range(len(GOLDEN)))
def test_marked_variant_avg(parsed, i):
    assert parsed[i]["vavg"] == GOLDEN[i][2], GOLDEN[i][0]


def test_parser_is_native(spark):
    """No Python UDF in the salary plan: it stays in whole-stage codegen."""
    df = J.with_salary_columns(spark.createDataFrame([("15 Tr VND",)], "s string"), "s")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_each_regex_runs_once(spark):
    """The normalized text is computed once, not inlined into every branch."""
    df = J.with_salary_columns(spark.createDataFrame([("15 Tr VND",)], "s string"), "s")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("(\\d+(\\.\\d+)?)[^\\d]+(\\d+(\\.\\d+)?), 1)") == 1
    assert df.first()["avg"] == 15e6
