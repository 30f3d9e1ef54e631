"""Physical-plan checks: what should and should not be in the plans."""


from jobtide import operators as O
from jobtide import plans
from jobtide import sources as S

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_has_no_python_udf(spark):
    p = plan_of(O.mart_clean(S.jobs_as_lake(S.jobs(spark, SF))))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_mart_prunes_columns_at_scan(spark):
    p = plan_of(O.mart_clean(S.jobs_as_lake(S.jobs(spark, SF))))
    # o_orderstatus, o_totalprice, o_orderpriority are never read.
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_dedup_is_partial_aggregate(spark):
    keyed = O.with_dedup_key(S.jobs_as_lake(S.jobs(spark, SF)))
    p = plan_of(O.dedup_batch(keyed))
    assert "partial_min" in p and "Window" not in p


def test_only_the_key_goes_through_python(spark):
    keyed = O.with_dedup_key(S.jobs_as_lake(S.jobs(spark, SF)))
    p = plan_of(keyed)
    assert p.count("ArrowEvalPython") == 1


def test_anti_join_plan(spark):
    keyed = O.with_dedup_key(S.jobs_as_lake(S.jobs(spark, SF)))
    seen = O.seen_keys(keyed, keys=["dedup_key"])
    p = plan_of(O.drop_seen(keyed, seen, keys=["dedup_key"]))
    assert "LeftAnti" in p


def test_keywords_no_python(spark):
    p = plan_of(O.top_keywords(S.load_table(spark, SF, "documents")))
    assert "Python" not in p and "WindowGroupLimit" in p


def test_keywords_shuffle_four_times(spark):
    df = O.top_keywords(S.load_table(spark, SF, "documents"))
    assert plan_of(df).count("Exchange hashpartitioning") <= 4


def test_no_query_deals_rows_round_robin(spark):
    for name in ("mart_clean", "dedup_batch", "top_keywords", "page_fields"):
        assert "RoundRobin" not in plan_of(plans.QUERIES[name](spark, SF)), name


def test_page_patterns_scan_once(spark):
    p = plan_of(O.page_fields(S.load_table(spark, SF, "pages")))
    assert p.count("</li>") == 1 and p.count("</p>") == 1
