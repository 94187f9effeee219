"""Physical-plan checks: the shapes that matter at scale."""

import pytest
from conftest import SF001

from facets.plans.supplied import QUERIES


def plan(df) -> str:
    df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cartesian(spark, name):
    p = plan(QUERIES[name](spark, SF001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["topk"](spark, SF001))


def test_per_group_top_k_limits_before_shuffle(spark):
    df = QUERIES["per_bin_top_codes"](spark, SF001)
    s = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in s


def test_year_filter_reaches_scan(spark):
    p = plan(QUERIES["year_filter"](spark, SF001))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in p


def test_column_pruning(spark):
    p = plan(QUERIES["topk"](spark, SF001))
    assert "ReadSchema: struct<p_brand:string>" in p


def test_restriction_broadcasts_only_top_k(spark):
    p = plan(QUERIES["restrict_null_key"](spark, SF001))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_clock_parser_not_inlined_into_bin_filter(spark):
    # dropna over bins of a parsed hour must test the bound value, not copies of the parser
    p = plan(QUERIES["clock_bin_counts"](spark, SF001))
    assert "Generate inline" in p
    filt = [ln for ln in p.splitlines() if "atleastnnonnulls" in ln]
    assert filt and all("date_format" not in ln for ln in filt)


def test_citation_chain_plans(spark, raw):
    from facets.plans.citations import clean_citations, time_bins

    clean = clean_citations(raw)
    landing = clean.sortWithinPartitions("Issue_Date")
    lp = landing._jdf.queryExecution().executedPlan().toString()
    assert "Sort [Issue_Date" in lp and "Exchange" not in lp          # per-task sort, no shuffle
    tb = time_bins(clean)
    tp = tb._jdf.queryExecution().optimizedPlan().toString()
    filt = [ln for ln in tp.splitlines() if "atleastnnonnulls" in ln]
    assert filt and all("substring" not in ln for ln in filt)        # parser bound, not inlined


def test_report_reads_the_table_only_where_it_must(spark, raw, tmp_path):
    from facets.plans.citations import citation_report, clean_citations, land_cleaned

    landed = land_cleaned(clean_citations(raw), str(tmp_path / "landed"))
    report = citation_report(landed)
    scanning = sorted(name for name, df in report.items()
                      if "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString())
    assert scanning == ["unbinned"]   # the rest read the two cubes and the one aggregate, checkpointed


def test_quality_checks_read_the_file_once(spark, raw):
    from facets.plans.citations import quality_checks

    q = quality_checks(raw)   # materializes one aggregate by year: one CSV pass
    for name, df in q.items():
        assert "FileScan csv" not in df._jdf.queryExecution().executedPlan().toString(), name


def _final(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_null_profile_shuffles_flags_only(spark):
    from conftest import SF001

    from facets.plans.supplied import QUERIES

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = QUERIES["null_profile"](spark, SF001)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Join"):]
        project = next(x for x in below.splitlines() if "Project" in x)
        assert "isnull(text" in project and " text#" not in project.split("isnull(text")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rates_table_is_streamed(spark):
    """With automatic broadcasts off, no raw rate goes through an exchange: only
    partial aggregates of at most k keys do."""
    from facets.operators import priced_top_k

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        codes = spark.range(1000).selectExpr("id % 7 as code")
        rates = spark.range(5000).selectExpr("id as code", "id * 2 as fine")
        out = priced_top_k(codes, "code", 3, rates)
        plan = _final(out)
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and "LeftSemi" in plan
        assert sorted(tuple(r) for r in out.collect()) == [(0, 143, 0, 0), (1, 143, 2, 286), (2, 143, 4, 572)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bins_of_top_codes_scans_once(spark):
    from conftest import SF001

    from facets.plans.supplied import QUERIES

    df = QUERIES["bins_of_top_codes"](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1


def test_hour_is_computed_once(spark):
    from conftest import SF001

    from facets.plans.supplied import QUERIES

    plan = QUERIES["bin_counts"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("hour(") <= 2


def test_file_checkpoint_folder_refused_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from facets.session import ensure_checkpoint_dir

    def session(master, folder):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: folder),
                               sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: folder))

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(session("yarn", "file:///tmp/x"))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(session("yarn", None))
    assert ensure_checkpoint_dir(session("yarn", "hdfs:///x")) == "hdfs:///x"
