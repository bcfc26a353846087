"""Data-quality audits (Q1-Q9, A3-A9) as DataFrames.

Every audit is one distributed job over the data; what reaches the driver (if
anything) is bounded by the number of columns or rules, never by the rows.
Several columns are always checked in one pass (a single aggregation or an
``explode`` of per-column findings), not one scan per column.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.functions.text import is_bad_number


def _present(df: DataFrame, cols) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def code_label_conflicts(df: DataFrame, pairs, list_labels: bool = False) -> DataFrame:
    """Codes carrying more than one distinct label.

    All pairs in one pass: each row is expanded to one (pair, code, label)
    triple per pair, de-duplicated with partial aggregation before the
    shuffle, then counted per (pair, code). Output: code_column, label_column,
    code (as text), n_labels. With ``list_labels`` there is one row per
    conflicting label instead (a join back to the distinct triples), so no
    code's labels are ever gathered into a single value or task.
    """
    pairs = [(c, t) for c, t in pairs if c in df.columns and t in df.columns]
    if not pairs:
        raise ValueError("no code/label pair is present")
    triples = F.explode(F.array(*[
        F.struct(F.lit(c).alias("code_column"), F.lit(t).alias("label_column"),
                 F.col(c).cast("string").alias("code"), F.col(t).cast("string").alias("label"))
        for c, t in pairs])).alias("p")
    flat = df.select(triples).select("p.*").where(F.col("code").isNotNull() & F.col("label").isNotNull())
    distinct = flat.distinct()
    keys = ["code_column", "label_column", "code"]
    out = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_labels")).where(F.col("n_labels") > 1)
    if list_labels:
        return distinct.join(out, keys).select(*keys, "label", "n_labels")
    return out


def non_numeric(df: DataFrame, cols) -> DataFrame:
    """Q2: per column, rows whose value is present but not a number (one pass).

    Output: column_name, bad_rows -- one row per checked column present.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = _present(df, cols)
    aggs = [F.sum(is_bad_number(F.col(c), types[c]).cast("long")).alias(f"__b{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', __b{i}" for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, bad_rows)").select(
        "column_name", F.coalesce(F.col("bad_rows"), F.lit(0)).cast("long").alias("bad_rows"))


def bad_rows(df: DataFrame, cols) -> DataFrame:
    """S7 input: every row with a non-numeric value, once per offending column,
    tagged with ``bad_column`` and ``bad_value`` (full row kept)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in _present(df, cols) if isinstance(types[c], T.StringType)]
    if not cols:
        return df.select(F.lit(None).cast("string").alias("bad_column"),
                         F.lit(None).cast("string").alias("bad_value"), "*").where(F.lit(False))
    tags = F.array(*[F.when(is_bad_number(F.col(c), types[c]),
                            F.struct(F.lit(c).alias("bad_column"), F.col(c).alias("bad_value")))
                     for c in cols])
    tagged = df.withColumn("__tag", F.explode(F.filter(tags, lambda x: x.isNotNull())))
    return tagged.select("__tag.bad_column", "__tag.bad_value", *df.columns)


def sample_bad_values(df: DataFrame, cols, n: int = 10) -> DataFrame:
    """For each column, its first ``n`` distinct bad values in text order.

    The top-n per column is a window with a group limit, cut on the map side
    before the shuffle. Output: column_name, bad_value, rank.
    """
    tagged = bad_rows(df, cols).select(F.col("bad_column").alias("column_name"), "bad_value").distinct()
    w = Window.partitionBy("column_name").orderBy("bad_value")
    return tagged.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def row_accounting(before: DataFrame, required) -> DataFrame:
    """A4/Q3: rows in, rows dropped for missing required values, rows out (one pass).

    Output: stage, rows.
    """
    required = _present(before, required)
    missing = reduce(operator.or_, [F.col(c).isNull() for c in required])
    one = before.agg(F.count(F.lit(1)).alias("n"), F.sum(missing.cast("long")).alias("d"))
    one = one.select(F.col("n").cast("long").alias("n"), F.coalesce("d", F.lit(0)).cast("long").alias("d"))
    return one.selectExpr("stack(3, 'input_rows', n, 'dropped_missing_required', d, 'output_rows', n - d) "
                          "AS (stage, rows)")


def unique_violations(df: DataFrame, keys) -> DataFrame:
    """Q6: key values occurring more than once, with their counts."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def null_violations(tables: dict[str, DataFrame], required: dict[str, list[str]]) -> DataFrame:
    """Q7: NULL counts of NOT NULL columns, one aggregation per table.

    Output: table_name, column_name, null_rows (one row per checked column).
    """
    parts = []
    for name, df in tables.items():
        cols = _present(df, required.get(name, []))
        if not cols:
            continue
        one = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(f"__n{i}") for i, c in enumerate(cols)])
        pairs = ", ".join(f"'{c}', __n{i}" for i, c in enumerate(cols))
        parts.append(one.selectExpr(f"'{name}' AS table_name", f"stack({len(cols)}, {pairs}) AS (column_name, null_rows)"))
    out = reduce(DataFrame.unionByName, parts)
    return out.select("table_name", "column_name", F.coalesce("null_rows", F.lit(0)).cast("long").alias("null_rows"))


def conditional_nulls(df: DataFrame, checks) -> DataFrame:
    """Q7 over one source: for each (table, column, rows that count, value), the rows
    that count whose value is NULL. All checks are one aggregation, so one scan.

    Output: table_name, column_name, null_rows.
    """
    aggs = [F.sum((F.coalesce(rows, F.lit(False)) & value.isNull()).cast("long")).alias(f"__n{i}")
            for i, (_, _, rows, value) in enumerate(checks)]
    triples = ", ".join(f"'{t}', '{c}', __n{i}" for i, (t, c, _, _) in enumerate(checks))
    out = df.agg(*aggs).selectExpr(f"stack({len(checks)}, {triples}) AS (table_name, column_name, null_rows)")
    return out.select("table_name", "column_name", F.coalesce("null_rows", F.lit(0)).cast("long").alias("null_rows"))


def range_violations(df: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    """Per column, non-NULL values outside [lo, hi] (one pass).

    Output: column_name, lo, hi, bad_rows.
    """
    cols = _present(df, bounds)
    aggs = [F.sum((~F.col(c).between(bounds[c][0], bounds[c][1])).cast("long")).alias(f"__r{i}")
            for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    rows = ", ".join(f"'{c}', CAST({bounds[c][0]} AS BIGINT), CAST({bounds[c][1]} AS BIGINT), __r{i}"
                     for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {rows}) AS (column_name, lo, hi, bad_rows)").select(
        "column_name", "lo", "hi", F.coalesce("bad_rows", F.lit(0)).cast("long").alias("bad_rows"))


def width_violations(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Q9: per text column, longest value and count of values over the width."""
    cols = _present(df, widths)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.max(F.length(c)).alias(f"__m{i}"), F.sum((F.length(c) > widths[c]).cast("long")).alias(f"__o{i}")]
    one = df.agg(*aggs)
    rows = ", ".join(f"'{c}', {widths[c]}, __m{i}, __o{i}" for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {rows}) AS (column_name, width, max_length, over_width)").select(
        "column_name", F.col("width").cast("int").alias("width"), F.col("max_length").cast("int").alias("max_length"),
        F.coalesce("over_width", F.lit(0)).cast("long").alias("over_width"))


def reference_violations(fact: DataFrame, refs) -> DataFrame:
    """Q5: for each foreign key, how many fact rows carry a non-NULL key with no
    matching dimension row (NULL keys pass).

    ``refs``: list of (fact column, dimension name, dimension DataFrame, dimension
    key column, dimension rows or None). All keys are checked in one pass over the
    fact: the fact is unpivoted to (number of fk, key) and counted per distinct key value
    (partial aggregation before the shuffle, on numbers alone); the values found in their
    dimension (left semi join, so repeated dimension keys cannot inflate
    counts) give orphans = checked - found. Output: fk_column, dimension,
    checked_rows, null_rows, orphan_rows.
    """
    per_value = fact.select(F.posexplode(F.array(*[F.col(r[0]).cast("long") for r in refs])).alias("fk", "k")).groupBy(
        "fk", "k").agg(F.count(F.lit(1)).alias("n"))
    dim_keys = reduce(DataFrame.unionByName, [
        dim.select(F.lit(i).alias("fk"), F.col(key).cast("long").alias("k")) for i, (_, _, dim, key, _) in enumerate(refs)])
    found = per_value.join(dim_keys, ["fk", "k"], "left_semi").select(
        "fk", "k", F.lit(None).cast("long").alias("n"), F.col("n").alias("found"))
    both = per_value.select("fk", "k", "n", F.lit(None).cast("long").alias("found")).unionByName(found)
    totals = both.groupBy("fk").agg(
        F.sum(F.when(F.col("k").isNotNull(), F.col("n"))).alias("checked_rows"),
        F.sum(F.when(F.col("k").isNull(), F.col("n"))).alias("null_rows"),
        F.sum("found").alias("found_rows"))
    names = fact.sparkSession.createDataFrame([(i, c, d) for i, (c, d, *_) in enumerate(refs)], "fk int, fk_column string, dimension string")
    out = F.broadcast(names).join(totals, "fk", "left")  # one row per declared key
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return out.select("fk_column", "dimension", z("checked_rows").alias("checked_rows"),
                      z("null_rows").alias("null_rows"), (z("checked_rows") - z("found_rows")).alias("orphan_rows"))
