"""Spec-driven dimensions (D0), keys, load modes (D1-D3) and membership joins
(J7, J9, J10).

A dimension is declared, not coded: which staging rows qualify, how each
output column is computed (casts, defaults, code-to-label maps, widths), the
natural key, and what to do when one natural key carries several labels.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from functools import reduce
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dimloom.operators.keys import DEFAULT_BUCKET_ROWS, Keyed, assign_keys, continue_keys, size_aggregates, size_stats
from dimloom.operators.observed import observed
from dimloom.session import new_scratch_path


@dataclass(frozen=True)
class Out:
    """One output column: name, expression over staging, type, optional width."""

    name: str
    expr: Callable[[], Column]
    dtype: str | None = None
    width: int | None = None

    def column(self) -> Column:
        c = self.expr()
        if self.dtype:
            c = c.try_cast(self.dtype)
        if self.width:
            c = F.substring(c, 1, self.width)
        return c.alias(self.name)


@dataclass(frozen=True)
class DimSpec:
    name: str
    key: str
    columns: tuple[Out, ...]
    natural: tuple[str, ...]
    where: Callable[[], Column] | None = None
    # 'min_label': one member per natural key (smallest remaining values);
    # 'keep_all': every distinct row, as a plain SELECT DISTINCT would load.
    on_conflict: str = "min_label"
    # Members whose natural key is NULL can never be matched and break NOT NULL
    # columns; they are left out (and counted by the not-null audit).
    drop_null_natural: bool = True
    load_mode: str = "insert_new"  # or 'if_empty'
    order_by: tuple[str, ...] = field(default=())

    @property
    def out_names(self) -> list[str]:
        return [o.name for o in self.columns]

    @property
    def unique_on(self) -> tuple[str, ...]:
        """Columns on which members are unique by the way they are built and appended (none where a
        NULL may stand in the natural key: it never matches, so it can be appended again)."""
        return self.natural if self.on_conflict == "min_label" and self.drop_null_natural else ()

    @property
    def ordering(self) -> list[str]:
        return list(self.order_by) if self.order_by else self.out_names


def label_case(src: Callable[[], Column], labels, null_label=None, else_label=None) -> Callable[[], Column]:
    """Code-to-label map as a chained CASE."""

    def build() -> Column:
        c = src()
        expr = None
        if null_label is not None:
            expr = F.when(c.isNull(), F.lit(null_label))
        for value, text in labels:
            expr = F.when(c == F.lit(value), F.lit(text)) if expr is None else expr.when(c == F.lit(value), F.lit(text))
        return expr.otherwise(F.lit(else_label)) if else_label is not None else expr

    return build


def candidates(staging: DataFrame, spec: DimSpec) -> DataFrame:
    """D0 before de-duplication: qualifying rows projected to dimension columns."""
    src = staging.where(spec.where()) if spec.where else staging
    return src.select(*[o.column() for o in spec.columns])


def build_dimension(staging: DataFrame, spec: DimSpec) -> DataFrame:
    """Distinct members (partial aggregation before the shuffle), NULL natural
    keys dropped, and the conflict policy applied."""
    members = candidates(staging, spec)
    if spec.drop_null_natural:
        members = members.where(reduce(operator.and_, [F.col(c).isNotNull() for c in spec.natural]))
    rest = [c for c in spec.out_names if c not in spec.natural]
    if spec.on_conflict == "min_label" and rest:
        # Smallest remaining values per natural key, taken as one struct so the
        # member is a real (code, label) pair. min() on a struct orders NULL first.
        picked = members.groupBy(*spec.natural).agg(F.min(F.struct(*rest)).alias("__m"))
        return picked.select(*[F.col(c) if c in spec.natural else F.col(f"__m.{c}").alias(c)
                               for c in spec.out_names])
    if spec.on_conflict not in ("min_label", "keep_all"):
        raise ValueError(f"unknown conflict policy {spec.on_conflict}")
    return members.distinct()


def keyed_dimension(staging: DataFrame, spec: DimSpec, start: int = 0,
                    bucket_rows: int | None = DEFAULT_BUCKET_ROWS) -> Keyed:
    """D0 + K1: members with dense keys from ``start + 1`` in the spec's order."""
    return assign_keys(build_dimension(staging, spec), spec.ordering, spec.key, start, bucket_rows)


def new_rows(incoming: DataFrame, existing: DataFrame, on, incoming_rows: int | None = None,
             incoming_text_bytes: int | None = None) -> DataFrame:
    """Incoming rows whose natural key is not present yet (left anti join).

    NULL keys never match, so they pass -- as NOT EXISTS behaves.

    When the incoming batch has a known row count whose keys fit the broadcast
    budget, the (possibly huge) existing table is never shuffled: its key
    columns are semi-joined against the broadcast batch keys (a scan), and the
    batch is anti-joined against those hits, of which there are at most as
    many as distinct batch keys. Otherwise both sides are shuffled (sort-merge).
    """
    from dimloom.operators.fact import fits_broadcast

    on = [on] if isinstance(on, str) else list(on)
    keys = incoming.select(*on)
    if fits_broadcast(incoming.sparkSession, incoming_rows, keys.schema, incoming_text_bytes):
        batch_keys = F.broadcast(keys)
        hits = existing.select(*on).join(batch_keys, [existing[c] == batch_keys[c] for c in on], "left_semi")
        hits = F.broadcast(hits.distinct())
        return incoming.join(hits, [incoming[c] == hits[c] for c in on], "left_anti")
    # NULL keys would all go to one reducer of the join, to match nothing: they pass beside it.
    known = reduce(operator.and_, [F.col(c).isNotNull() for c in on])
    rest = incoming.where(known)
    old = existing.select(*on).hint("merge")
    fresh = rest.join(old, [rest[c] == old[c] for c in on], "left_anti")
    return fresh.unionByName(incoming.where(~known))


def insert_new(staging: DataFrame, spec: DimSpec, existing: DataFrame,
               bucket_rows: int | None = DEFAULT_BUCKET_ROWS) -> Keyed:
    """D1 + K2: members not in ``existing`` (by natural key), numbered after its
    largest key. Returns only the rows to append.

    The members are written first, and counted as they are: staging is then read once, and the anti join meets
    members only (Spark would push it below their aggregation, to all rows of staging)."""
    members = build_dimension(staging, spec)
    path, seen = new_scratch_path(staging.sparkSession, "members"), Observation()
    sizes = size_aggregates(members.select(*spec.natural))
    members.observe(seen, *sizes).write.parquet(path)
    members = staging.sparkSession.read.schema(members.schema).parquet(path)
    got = observed(seen)
    rows, text_bytes = (int(got["n"]), int(got["b"])) if got else size_stats(members.select(*spec.natural))
    fresh = new_rows(members, existing, list(spec.natural), rows, text_bytes)
    return continue_keys(fresh, existing, spec.ordering, spec.key, bucket_rows)


def members_in_use(dim: DataFrame, facts: DataFrame, pairs, null_as: dict | None = None) -> DataFrame:
    """Dimension members referenced by at least one fact row.

    ``pairs`` is a list of (dim column, fact expression). A left semi join
    returns each member once without a DISTINCT over the join output.
    ``null_as`` maps dim columns compared with NULL replaced on both sides.
    """
    null_as = null_as or {}
    fact_cols, cond = [], []
    for i, (dcol, fexpr) in enumerate(pairs):
        fe = fexpr if isinstance(fexpr, Column) else F.col(fexpr)
        if dcol in null_as:
            fe = F.coalesce(fe, F.lit(null_as[dcol]))
        fact_cols.append(fe.alias(f"__f{i}"))
    # Distinct key values first: partial aggregation shrinks the (possibly huge,
    # possibly skewed) fact side on the map side before anything is shuffled.
    used = facts.select(*fact_cols).distinct()
    for i, (dcol, _) in enumerate(pairs):
        dc = dim[dcol]
        if dcol in null_as:
            dc = F.coalesce(dc, F.lit(null_as[dcol]))
        cond.append(dc == used[f"__f{i}"])
    return dim.join(used, cond, "left_semi")
