"""Driver contract: entry, registry and oracles agree on the small tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from paths import SF_TINY

TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["eventid", "DateKey", "LocationKey"]


def test_every_oracle_has_a_query():
    qs, orc = entry.queries(), entry.oracle_sql()
    assert set(orc) <= set(qs)
    own = {q for q in qs if not q.startswith("op") and q != "pipeline"}
    assert own <= set(orc)


def _canon(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    return "NULL" if v is None else str(v)


@pytest.mark.parametrize("name", ["clean_sparse_columns", "dim_location", "fact_view", "audit_references",
                                  "key_dense", "audit_alignment_labels", "fact_load_incremental", "filter_valid_date",
                                  "fact_rejects", "audit_width", "audit_references_planted", "audit_row_counts", "audit_not_null",
                                  "audit_null_profile", "run_status"])
def test_matches_oracle_on_tiny(spark, name):
    sdf = entry.queries()[name](spark, SF_TINY)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_TINY}/{t}.parquet')")
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == sorted(sdf.columns)

    def norm(cols, rows):
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted("|".join(_canon(r[i]) for i in idx) for r in rows)

    assert norm(sdf.columns, [tuple(r) for r in sdf.collect()]) == norm(dcols, res.fetchall())
