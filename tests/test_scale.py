"""Plans and files of the steps that every load shares: what grows with the rows stays small."""

from dimloom.operators.clean import normalize_text
from dimloom.plans import pipeline
from dimloom.session import COMPILED_BYTES, HUGE_METHOD, ensure_checkpoint_dir
from dimloom.sources.fixtures import raw_incidents
from tests.paths import SF_TINY


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_generated_methods_stay_compiled(spark):
    ensure_checkpoint_dir(spark)
    assert int(spark.conf.get(HUGE_METHOD)) == COMPILED_BYTES


def test_text_is_stripped_once_without_arrays(spark):
    df = spark.createDataFrame([(" Unknown\t",), ("\nKabul ",), (None,), ("",), ("<NA>",)], "v string")
    out = normalize_text(df)
    assert [r["v"] for r in out.collect()] == [None, "kabul", None, None, None]
    plan = _plan(out)
    assert "array_except" not in plan and plan.count("trim(") == 1


def test_staging_writes_no_table_before_it(spark):
    pipeline.forget_staging()
    pipeline.stage(spark, SF_TINY)
    assert not pipeline._filled
    before = sorted(map(str, pipeline.renamed(spark, SF_TINY).collect()))
    pipeline._renamed.clear()
    pipeline.filled(spark, SF_TINY)
    assert sorted(map(str, pipeline.renamed(spark, SF_TINY).collect())) == before
    pipeline.forget_staging()


def test_geography_joins_last(spark):
    lines = _plan(raw_incidents(spark, SF_TINY)).splitlines()
    first_join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert "n_nationkey" in lines[first_join]
