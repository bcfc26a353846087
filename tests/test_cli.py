"""The three command-line stages chained: clean a raw CSV, stage it, build."""

import os

from dimloom import cli
from dimloom.plans.warehouse import Warehouse
from dimloom.sources.files import write_clean
from dimloom.sources.fixtures import raw_incidents

from paths import SF_TINY


def test_clean_stage_build(spark, tmp_path):
    raw_csv = str(tmp_path / "raw")
    write_clean(raw_incidents(spark, SF_TINY), raw_csv, "csv", encoding="ISO-8859-1")
    cleaned, bad, staged, wh = (str(tmp_path / n) for n in ("cleaned", "bad", "staged", "wh"))
    assert cli.main(["clean", "--input", raw_csv, "--output", cleaned, "--quarantine", bad]) == 0
    assert any(d.startswith("bad_column=") for d in os.listdir(bad))
    assert cli.main(["stage", "--input", cleaned, "--parquet", staged]) == 0
    st = spark.read.parquet(staged)
    assert "num_killed" in st.columns and "summary" not in st.columns
    assert not os.path.exists(cleaned + "_filled.parquet") and os.path.exists(cleaned + "_reports/conflicts")
    assert cli.main(["build", "--input", staged, "--warehouse", wh]) == 0
    fact = Warehouse(spark, wh).table("Fact_Terror_Events")
    assert fact.count() > 0 and fact.count() == fact.select("EventID").distinct().count()
    from dimloom.plans.catalog import QUERIES

    direct = QUERIES["fact_view"](spark, SF_TINY)
    assert fact.count() == direct.count()
    assert sorted(int(r.EventID) for r in fact.select("EventID").collect()) == \
        sorted(r.eventid for r in direct.select("eventid").collect())


def test_build_without_tie_columns(spark, tmp_path):
    """Real incident files have no tie columns: the order over all columns picks the survivor."""
    staged, wh = str(tmp_path / "staged"), str(tmp_path / "wh")
    raw_incidents(spark, SF_TINY).drop("tie1", "tie2", "tie3").write.parquet(staged)
    assert cli.main(["build", "--input", staged, "--warehouse", wh]) == 0
    fact = Warehouse(spark, wh).table("Fact_Terror_Events")
    assert fact.count() > 0 and fact.count() == fact.select("EventID").distinct().count()
    assert not os.path.exists(f"{wh}/_staging") or not os.listdir(f"{wh}/_staging")
    assert not os.listdir(f"{wh}/_batches")
    assert cli.event_order(["b", "tie2", "a", "eventid"]) == ["tie2", "a", "b"]
    assert cli.event_order(["b", "a", "eventid"], ["b"]) == ["b", "a"]
