"""Plan shape: flatten stays in JVM expressions; server filters reach the Parquet scan."""

from feedlake.operators.entity import flatten_entity, flatten_matches
from feedlake.sources import feeds
from feedlake.sources.landing import explode_records


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flatten_has_no_python(spark, sf):
    plan = _plan(flatten_matches(feeds.matches_landing(spark, sf)))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "MapInPandas" not in plan


def test_request_filters_pushed_into_orders_scan(spark, sf):
    plan = _plan(feeds.matches_landing(spark, sf, season=1996, status="FINISHED"))
    scan = [ln for ln in plan.split("\n") if "FileScan" in ln and "o_orderkey" in ln][0]
    pushed = scan[scan.index("PushedFilters"):]
    # the plan text truncates long filter lists; the status equality shows as its IsNotNull companion
    assert "IsNotNull(o_orderstatus)" in pushed and "GreaterThanOrEqual(o_orderdate" in pushed


def _largest_method(spark, df):
    parts = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size()))


def test_flatten_code_is_compiled_by_the_jvm(spark, sf, tmp_path):
    for entity, landing in (("matches", feeds.matches_landing), ("standings", feeds.standings_landing)):
        landing(spark, sf).write.parquet(f"{tmp_path}/{entity}")
        flat = flatten_entity(spark.read.parquet(f"{tmp_path}/{entity}"), entity).valid
        assert 0 < _largest_method(spark, flat) < 8000


def test_type_of_a_sound_standings_group_is_not_worked_out_per_row(spark, sf, tmp_path):
    feeds.standings_landing(spark, sf).write.parquet(f"{tmp_path}/pages")
    plan = _plan(explode_records(spark.read.parquet(f"{tmp_path}/pages"), "standings"))
    generates = [ln for ln in plan.split("\n") if "Generate posexplode" in ln]
    assert len(generates) == 2 and not any("chemaOfVariant" in ln for ln in generates)
    assert "CASE WHEN isnull(_rows" in plan
