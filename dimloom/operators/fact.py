"""Fact operators: de-duplication (W1), key lookups (J1-J6), the fact view (F1)
and the incremental fact load (F2, J8)."""

from __future__ import annotations

import json
import operator
import re
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.functions.dates import date_key, valid_date
from dimloom.operators.keys import Keyed, size_aggregates, size_stats
from dimloom.operators.observed import observed
from dimloom.operators.places import first_rows
from dimloom.session import new_scratch_path


@dataclass(frozen=True)
class LookupSpec:
    """Resolve fact rows to one dimension's key.

    ``pairs``: (dimension column, fact column) equalities. ``defaults``: per
    pair index, a value the fact side takes when NULL (ISNULL(code, default)).
    ``carry``: further dimension columns brought along with the key.
    """

    dim: str
    key: str
    pairs: tuple[tuple[str, str], ...]
    how: str = "left"
    carry: tuple[str, ...] = ()
    defaults: dict = field(default_factory=dict)
    # NULL-safe equality (NULL matches NULL) instead of SQL '='.
    null_safe: bool = False
    # Pairs (by index) of texts that match under ``collation``, for instance whatever their case
    # and trailing spaces. Spark hashes no collated text, so it is the different texts of the facts
    # that are matched by a sort-merge join, and the facts then meet those by plain equality.
    collated: tuple[int, ...] = ()
    collation: str = "UTF8_LCASE_RTRIM"

    def fact_expr(self, i: int) -> Column:
        col = F.col(self.pairs[i][1])
        col = F.coalesce(col, F.lit(self.defaults[i])) if i in self.defaults else col
        return F.collate(col, self.collation) if i in self.collated else col

    def dim_expr(self, i: int) -> Column:
        col = F.col(self.pairs[i][0])
        return F.collate(col, self.collation) if i in self.collated else col


_SIZE = re.compile(r"^\s*(-?\d+)\s*([kmgt]?)i?b?\s*$", re.I)


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes (-1: broadcasting disabled)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")
    m = _SIZE.match(raw)
    if not m:
        return 10 * 1024 * 1024
    n, unit = int(m.group(1)), m.group(2).lower()
    return n * {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}[unit]


_FIXED_BYTES = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4}


def row_bytes(schema: T.StructType, string_bytes: int = 64) -> int:
    """Estimated in-memory bytes of one row (8 for other fixed-width types)."""
    size = 16
    for f in schema.fields:
        dt = f.dataType
        size += string_bytes if isinstance(dt, T.StringType) else _FIXED_BYTES.get(type(dt), 8)
    return size


def fits_broadcast(spark: SparkSession, rows: int | None, schema: T.StructType,
                   text_bytes: int | None = None) -> bool:
    """Broadcast only a side whose row count is known (exactly or as an upper
    bound) and whose size is inside the session's threshold. With
    ``text_bytes`` (measured total bytes of its text) the size is exact up to
    per-row overhead; without it, text is assumed to take 64 bytes a value."""
    limit = broadcast_limit(spark)
    if rows is None or limit <= 0:
        return False
    if text_bytes is None:
        return rows * row_bytes(schema) <= limit
    fixed = row_bytes(T.StructType([f for f in schema.fields if not isinstance(f.dataType, T.StringType)]))
    n_text = sum(isinstance(f.dataType, T.StringType) for f in schema.fields)
    return rows * (fixed + 8 * n_text) + text_bytes <= limit


def dedupe(df: DataFrame, keys, order_by, written: bool = False) -> DataFrame:
    """Keep the first row per key under a total ``order_by``.

    Plans as a window with a group limit of 1 applied on both sides of the
    shuffle, so a key with very many copies is cut to one row per map task
    before it is shuffled. ``written``: df is read from one written table, by
    projections and filters only; then just keys, order and places of its rows are
    shuffled, and the rows themselves are read where they lie (``places.first_rows``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not order_by:
        raise ValueError("dedupe needs an explicit order_by so the survivor is repeatable")
    if written:
        kept = first_rows(df, keys, list(order_by), broadcast_limit(df.sparkSession) > 0)
        if kept is not None:
            return kept
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


HOT_SHARE = 0.01        # a key holding at least 1% of sampled rows is hot
HOT_SAMPLE = 0.01       # fraction of the source sampled to find hot keys
SALTS = 32              # ways a hot key is split


def hot_keys(source: DataFrame, exprs: list[Column], share: float = HOT_SHARE,
             fraction: float = HOT_SAMPLE, seed: int = 11) -> list[tuple]:
    """Key values holding at least ``share`` of a sample of ``source``.

    Two small jobs over a sample; at most 1/share rows reach the driver.
    """
    sample = source.sample(False, fraction, seed).select(*[e.alias(f"__h{i}") for i, e in enumerate(exprs)])
    total = sample.count()
    if total == 0:
        return []
    names = [f"__h{i}" for i in range(len(exprs))]
    rows = (sample.groupBy(*names).count().where(F.col("count") >= F.lit(max(1.0, share * total)))
            .select(*names).collect())
    return [tuple(r) for r in rows if all(v is not None for v in r)]


def hot_lookup_keys(source: DataFrame, specs: list[LookupSpec], share: float = HOT_SHARE,
             fraction: float = HOT_SAMPLE, seed: int = 11) -> list[list[tuple]]:
    """For each lookup, the fact key values (as text) that hold at least ``share`` of a sample of ``source``.

    One aggregation for all lookups: a frequent-items sketch for each, over its key's values put
    together as JSON. A sketch's counts are too high or low by far less than ``share`` of
    the rows. At most 1/share values a lookup reach the driver."""
    if not specs:
        return []
    most = int(1 / share)

    def item(spec: LookupSpec) -> Column:
        keys = [F.col(f"__k{spec.dim}_{i}") for i in range(len(spec.pairs))]
        known = reduce(operator.and_, [k.isNotNull() for k in keys])  # NULL keys never match
        return F.when(known, F.to_json(F.array(*keys)))

    def text(spec: LookupSpec, i: int) -> Column:
        # a collated text counts under one of its forms, which matches all of them
        value = F.coalesce(F.col(spec.pairs[i][1]), F.lit(spec.defaults[i])) if i in spec.defaults else F.col(spec.pairs[i][1])
        return F.lower(F.rtrim(value)) if i in spec.collated else value.cast("string")

    sample = source.sample(False, fraction, seed).select(
        *[text(s, i).alias(f"__k{s.dim}_{i}") for s in specs for i in range(len(s.pairs))])
    items = sample.select(*[item(s).alias(f"__i{n}") for n, s in enumerate(specs)])
    got = items.agg(F.count(F.lit(1)).alias("n"), *[
        F.expr(f"approx_top_k(__i{n}, {most + 1}, {100 * most})").alias(f"t{n}") for n in range(len(specs))]).first()
    least = max(1.0, share * got["n"])
    return [[tuple(json.loads(t["item"])) for t in got[f"t{n}"] or () if t["item"] is not None and t["count"] >= least]
            for n in range(len(specs))]


def reduced_side(dim: DataFrame, spec: LookupSpec, unique_on: tuple[str, ...] = ()) -> DataFrame:
    """A2 for a lookup: one row per natural key (smallest key, its carried
    columns), natural key columns renamed __d0, __d1, ... A dimension known to
    be unique on them is taken as it is, without a shuffle."""
    named = [spec.dim_expr(i).alias(f"__d{i}") for i in range(len(spec.pairs))]
    if unique_on and set(unique_on) <= {d for d, _ in spec.pairs} and not spec.collated:
        return dim.select(*named, spec.key, *spec.carry)
    aggs = [F.min(spec.key).alias(spec.key)] + [F.min_by(c, spec.key).alias(c) for c in spec.carry]
    return dim.groupBy(*named).agg(*aggs).select(*[f"__d{i}" for i in range(len(named))], spec.key, *spec.carry)


def collated_members(fact: DataFrame, dim: DataFrame, spec: LookupSpec) -> Keyed:
    """The dimension of a collated lookup as the facts write it: one row for each different key of ``fact`` that
    matches, with its key and carried columns. Written once and counted while it is written."""
    k = range(len(spec.pairs))
    plain = replace(spec, collated=())
    names = [d for d, _ in spec.pairs]
    texts = fact.select(*[plain.fact_expr(i).alias(f"__t{i}") for i in k])
    if not spec.null_safe:  # NULL keys never match
        texts = texts.na.drop(subset=[f"__t{i}" for i in k])
    side = reduced_side(dim, spec).hint("merge")
    collated = [F.collate(f"__t{i}", spec.collation) if i in spec.collated else F.col(f"__t{i}") for i in k]
    cond = [c.eqNullSafe(side[f"__d{i}"]) if spec.null_safe else c == side[f"__d{i}"] for i, c in enumerate(collated)]
    found = texts.distinct().join(side, cond).select(*[F.col(f"__t{i}").alias(d) for i, d in enumerate(names)], spec.key, *spec.carry)
    path, seen = new_scratch_path(fact.sparkSession, "matched"), Observation()
    found.observe(seen, *size_aggregates(found)).write.parquet(path)
    df = fact.sparkSession.read.schema(found.schema).parquet(path)
    got = observed(seen)
    rows, text_bytes = (int(got["n"]), int(got["b"])) if got else size_stats(df)
    return Keyed(df, rows, spec.key, text_bytes, tuple(names))


def lookup(fact: DataFrame, dim: DataFrame, spec: LookupSpec, dim_rows: int | None = None,
           dim_text_bytes: int | None = None, hot: list[tuple] | None = None,
           salts: int = SALTS, unique_on: tuple[str, ...] = (), salt_on: tuple[str, ...] = (),
           texts: DataFrame | None = None) -> DataFrame:
    """Add ``spec.key`` (and carried columns) to every fact row.

    The dimension is first reduced to one key per natural key (the smallest,
    A2), so a dimension holding two labels for one code cannot multiply fact
    rows. It is broadcast when its measured size is small. Otherwise it is a
    sort-merge join; keys listed in ``hot`` (and NULL keys, which never match)
    are salted: those fact rows are spread over ``salts`` reducers by a hash of
    the row, and the dimension rows of hot keys are repeated once per salt, so
    no reducer receives a hot key's rows alone. AQE's skew handling covers
    hot keys not listed.

    ``salt_on``: columns that tell the fact's rows apart; only they are hashed, so that columns nobody reads
    don't travel (default: all). ``texts``: where a collated lookup finds the fact's texts (default: the fact).
    """
    if spec.collated:
        texts = fact if texts is None else texts
        found, plain = collated_members(texts, dim, spec), replace(spec, collated=())
        large = hot is not None and is_large(fact.sparkSession, found, plain)
        return lookup(fact, found.df, plain, found.rows, found.text_bytes, hot_lookup_keys(texts, [plain])[0] if large else None,
                      salts, found.unique_on, salt_on)
    dcols = [d for d, _ in spec.pairs]
    side = reduced_side(dim, spec, unique_on)
    # The reduced side has no more rows and no more text than the dimension.
    # Otherwise a merge hint keeps the planner from broadcasting on its own
    # static estimate (compressed file sizes are no bound on memory).
    broadcast = fits_broadcast(fact.sparkSession, dim_rows, side.schema, dim_text_bytes)
    side = F.broadcast(side) if broadcast else side.hint("merge")
    if spec.null_safe:
        cond = [spec.fact_expr(i).eqNullSafe(side[f"__d{i}"]) for i in range(len(dcols))]
    else:
        cond = [spec.fact_expr(i) == side[f"__d{i}"] for i in range(len(dcols))]
    drop = [f"__d{i}" for i in range(len(dcols))]
    if not broadcast and hot is not None:
        k = range(len(dcols))
        fact_key = F.struct(*[spec.fact_expr(i).alias(f"k{i}") for i in k])
        dim_key = F.struct(*[F.col(f"__d{i}").alias(f"k{i}") for i in k])
        # literals typed as each side's key, so the struct comparisons line up
        ftypes = fact.select(*[spec.fact_expr(i) for i in k]).schema.fields
        dtypes = side.select(*[f"__d{i}" for i in k]).schema.fields
        hot_f = [F.struct(*[F.lit(v).cast(ftypes[i].dataType).alias(f"k{i}") for i, v in enumerate(h)]) for h in hot]
        hot_lits = [F.struct(*[F.lit(v).cast(ftypes[i].dataType).try_cast(dtypes[i].dataType).alias(f"k{i}")
                               for i, v in enumerate(h)]) for h in hot]
        # NULL keys never match, unless equality is NULL-safe: then they stay with their match
        any_null = F.lit(False) if spec.null_safe else reduce(operator.or_, [spec.fact_expr(i).isNull() for i in k])
        is_hot = F.coalesce(fact_key.isin(*hot_f), F.lit(False)) if hot_f else F.lit(False)
        spread = any_null | is_hot
        # deterministic salt: a recomputed task sends each row to the same reducer
        salted_fact = fact.withColumn("__salt", F.when(spread, F.pmod(F.xxhash64(*(salt_on or fact.columns)), F.lit(salts)))
                                      .otherwise(F.lit(0)).cast("int"))
        replicas = F.when(dim_key.isin(*hot_lits), F.sequence(F.lit(0), F.lit(salts - 1))) if hot_lits else None
        salted_side = side.withColumn(
            "__salt", F.explode(replicas.otherwise(F.array(F.lit(0)))) if replicas is not None else F.lit(0))
        equal = (lambda i: spec.fact_expr(i).eqNullSafe(salted_side[f"__d{i}"])) if spec.null_safe \
            else (lambda i: spec.fact_expr(i) == salted_side[f"__d{i}"])
        cond = [equal(i) for i in k]
        joined = salted_fact.join(salted_side, cond + [salted_fact["__salt"] == salted_side["__salt"]], spec.how)
        return joined.drop(*drop, "__salt")
    joined = fact.join(side, cond, spec.how)
    return joined.drop(*drop)


def is_large(spark: SparkSession, keyed, spec: LookupSpec) -> bool:
    """Whether a lookup's dimension can't be broadcast."""
    side = reduced_side(keyed.df, spec, keyed.unique_on)
    return not fits_broadcast(spark, keyed.rows, side.schema, keyed.text_bytes)


def measured(spark: SparkSession, keyed: Keyed, spec: LookupSpec) -> Keyed:
    """The dimension with the size of what a lookup joins. The whole dimension bounds that; where the bound is too
    large to broadcast and members share their natural key, the reduced rows are counted (members differ
    in columns that the lookup doesn't match, so there can be far fewer)."""
    if spec.collated or keyed.rows is None or broadcast_limit(spark) <= 0 or not is_large(spark, keyed, spec):
        return keyed
    if keyed.unique_on and set(keyed.unique_on) <= {d for d, _ in spec.pairs}:
        return keyed
    rows, text_bytes = size_stats(reduced_side(keyed.df, spec))
    return replace(keyed, rows=rows, text_bytes=text_bytes)


def hot_for(source: DataFrame, keyed, spec: LookupSpec) -> list[tuple] | None:
    """Hot fact keys for a lookup whose dimension is too large to broadcast (else None)."""
    return hot_lookup_keys(source, [spec])[0] if is_large(source.sparkSession, keyed, spec) else None


def prepare_events(staging: DataFrame, order_by, dedupe_first: bool = True, written: bool = False) -> DataFrame:
    """W1 + P15 + J4: one row per event with a real date, and its date key.

    ``dedupe_first`` keeps the order 'pick the survivor, then drop it if its
    date is invalid'; False filters invalid dates before picking. ``written``: see ``dedupe``.
    """
    ok = valid_date(F.col("year"), F.col("month"), F.col("day"))
    if dedupe_first:
        events = dedupe(staging, ["eventid"], order_by, written).where(ok)
    else:
        events = dedupe(staging.where(ok), ["eventid"], order_by, written)
    return events.withColumn("DateKey", date_key(F.col("year"), F.col("month"), F.col("day")))


def resolve_star(events: DataFrame, dims: dict, lookups, hot_source: DataFrame | None = None,
                 salt_on: tuple[str, ...] = ()) -> DataFrame:
    """Every lookup in turn; ``dims`` maps dimension name to a Keyed table.

    For dimensions too large to broadcast, hot fact keys are found together, in one pass
    over a sample of ``hot_source`` (the staging table: a cheap columnar scan with
    the same key distribution as the events) and salted. ``salt_on``: see ``lookup``.
    """
    spark = events.sparkSession
    sized = {s.dim: measured(spark, dims[s.dim], s) for s in lookups}
    out, hot = events, {}
    if hot_source is not None:
        large = [s for s in lookups if not s.collated and is_large(spark, sized[s.dim], s)]
        hot = {s.dim: keys for s, keys in zip(large, hot_lookup_keys(hot_source, large), strict=True)}
        hot.update({s.dim: [] for s in lookups if s.collated})  # found among their own texts
    for spec in lookups:
        keyed = sized[spec.dim]
        out = lookup(out, keyed.df, spec, keyed.rows, keyed.text_bytes, hot.get(spec.dim), unique_on=keyed.unique_on,
                     salt_on=salt_on, texts=events)
    return out


def fact_view(staging: DataFrame, dims: dict, lookups, columns, order_by,
              dedupe_first: bool = True, written: bool = False) -> DataFrame:
    """de-duplicated, dated events resolved to all dimension keys. ``written``: see ``dedupe``."""
    events = prepare_events(staging, order_by, dedupe_first, written).withColumn("GTDCountryCode", F.col("country"))
    return resolve_star(events, dims, lookups, hot_source=staging, salt_on=("eventid",)).select(*columns)


def load_fact(view: DataFrame, existing: DataFrame, contract: T.StructType,
              renames: dict[str, str], id_col: str = "EventID", view_rows: int | None = None) -> DataFrame:
    """rows of ``view`` whose event is not yet in ``existing``, renamed and
    conformed to the fact contract (the rows to append). With ``view_rows``
    known, the existing fact is only scanned, never shuffled (see new_rows)."""
    from dimloom.operators.dims import new_rows
    from dimloom.sources.contracts import conform

    shaped = conform(view.withColumnsRenamed(renames), contract)
    return new_rows(shaped, existing, [id_col], view_rows)
