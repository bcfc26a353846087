"""Linking within groups of candidates, and connected components, by joins and grouped minima only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import number_rows
from .common import saved, small

#: Groups of at most this many members are compared pair by pair at once.
SMALL_GROUP = 5
#: Times that each node is compared with the next ones in an order that puts like ones together, before pairs of components are.
NEAR_ROUNDS, NEXT = 2, 3


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of edges (a, b): component is the smallest node that can be reached.

    Alternates large-star and small-star steps: each node's neighbours are handed to its smallest one. All is grouped
    minima and joins, so a node with very many neighbours isn't gathered anywhere; steps end when only stars are left."""
    now = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("a", "b", "m")
        step = small.select("a", F.col("m").alias("b")).union(small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        now = saved(step, name)
        # all are stars around a smallest node when no node has both a smaller and a larger neighbour, or two smaller ones
        chained = now.select(F.col("a").alias("node")).join(now.select(F.col("b").alias("node")), "node", "left_semi")
        forked = now.groupBy("a").count().filter("count > 1").select(F.col("a").alias("node"))
        if chained.union(forked).isEmpty():
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


@dataclass(frozen=True)
class Metric:
    """Distances that triangles bound, and the largest one that links. Both functions take saved pairs (a, b) with any further columns.

    exact: adds d, the distance. least: adds least, a lower bound of it that is cheap to have."""

    exact: Callable[[DataFrame], DataFrame]
    least: Callable[[DataFrame], DataFrame]
    limit: float


def _merged(comp: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """(node, component) after the links `found` are known as well."""
    if found.isEmpty():
        return comp
    at = comp.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    to = comp.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    joined = components(found.join(at, "a").join(to, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")), name)
    joined = small(joined.select(F.col("node").alias("component"), F.col("component").alias("new")))
    return saved(comp.join(joined, "component", "left").select("node", F.coalesce("new", "component").alias("component")), name)


def _open(members: DataFrame, comp: DataFrame, name: str) -> DataFrame:
    """(key, node, early, component) of the groups whose members aren't one component."""
    now = members.join(comp, "node").select("key", "node", "early", "component")
    ends = now.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi").select("key")
    return saved(now.join(ends, "key", "left_semi"), name)


def _stars(now: DataFrame, name: str) -> DataFrame:
    """Pairs (a, b) of each node and the pivot of those that took the same group (key, node, component)."""
    one = saved(now.groupBy("node", "component").agg(F.min_by("key", F.xxhash64("key")).alias("key")), name)
    pivots = saved(one.groupBy("key").agg(F.min_by(F.struct("node", "component"), "node").alias("p"), F.count("*").alias("n")).filter("n > 1"), name)
    met = one.join(small(pivots.select("key", "p")), "key").filter("component != p.component")
    return met.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()


def _neighbours(members: DataFrame, comp: DataFrame, turn: int, name: str) -> DataFrame:
    """Pairs (a, b) of different components that stand next to each other by least hashes of their groups."""
    marks = [f"m{i}" for i in range(3)]
    hashes = [F.min(F.xxhash64("key", F.lit(3 * turn + i))).alias(m) for i, m in enumerate(marks)]
    ordered = number_rows(members.groupBy("node").agg(*hashes), [*marks, "node"], "place").df
    here = ordered.select("place", "node", "m0").join(comp, "node")
    there = here.select(F.col("node").alias("next"), F.col("component").alias("its"), F.col("m0").alias("n0"), F.explode(F.array(*[F.col("place") - i for i in range(1, NEXT + 1)])).alias("place"))
    met = here.join(there, "place").filter("component != its and m0 = n0")
    return met.select(F.least("node", "next").alias("a"), F.greatest("node", "next").alias("b")).distinct()


def _different(members: DataFrame, name: str) -> DataFrame:
    """members without groups that repeat another group's nodes, as the windows of a family of near copies do, and without those that
    have no early member."""
    mark = F.xxhash64("node", "early")
    signs = members.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(mark).alias("x"), F.sum(F.shiftright(mark, 8)).alias("s"), F.max("early").alias("e"))
    signs = signs.filter("e = 1")
    keys = signs.groupBy("n", "x", "s").agg(F.min("key").alias("key")).select("key")
    return saved(members.join(small(saved(keys, name)), "key", "left_semi"), name)


def link_groups(members: DataFrame, verify: Callable[[DataFrame], DataFrame], name: str = "links", metric: Metric | None = None) -> tuple[DataFrame, DataFrame]:
    """Components of the links that `verify` finds among nodes that share a group; members: a saved table (key, node), or
    (key, node, early) where two nodes of a group needn't be compared in it unless early is 1 for one of them.

    verify: (a, b) pairs, a < b -> those that link. Returns ((node, component) of all member nodes, links checked to hold).

    1. Each node is compared with one pivot: it takes that of its groups which has the least hash, and those that took the same group
       have one pivot. Near copies share most of their groups, so they mostly take the same one, and a family of n of them becomes
       one component by about n comparisons, in however many groups it stands. For wider families `NEAR_ROUNDS` times all nodes are
       sorted by three least hashes of their groups (others each time), and each is compared with the next `NEXT` ones.
    2. What is left are pairs of different components in a group. A node of the smaller one meets the other: if that is one node, the two
       are compared. A larger one has a pivot, its smallest node, and its members' distances from it; by the triangle inequality only members are
       compared whose distance is within the limit of the node's own. A lower bound of this parts most pairs of node and component
       before anything exact is computed. Of each two components the pair of least bound goes first. Without a metric the node is
       compared with all members.

    So two nodes of a group have been compared, are in one component anyway, or are too far apart by the triangle inequality."""
    comp = saved(members.select("node").distinct().withColumn("component", F.col("node")), name)
    members = _different(members if "early" in members.columns else members.withColumn("early", F.lit(1).cast("long")), name)
    seen, links = None, None
    for turn in range(NEAR_ROUNDS + 1):
        pairs = _neighbours(members, comp, turn, name) if turn else _stars(_open(members, comp, name), name)
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        pairs = saved(pairs, name)
        if pairs.isEmpty():
            break
        found = saved(verify(pairs).select("a", "b"), name)
        seen = pairs if seen is None else seen.union(pairs)
        links = found if links is None else links.union(found)
        comp = _merged(comp, found, name)
    left = _open(members, comp, name)
    if not left.isEmpty():
        # first the nearest pair, as far as that is known, of each two components that may link, then what that leaves apart
        pairs = _left_over(left, comp, seen, metric, name)
        if metric is not None:
            pairs = saved(metric.least(pairs).filter(F.col("least") <= metric.limit + 1e-9), name)
            ends = pairs.join(comp.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a")
            ends = ends.join(comp.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b")
            best = F.min_by(F.struct("a", "b"), F.struct("least", "a", "b")).alias("p")
            best = saved(ends.groupBy(F.least("ca", "cb").alias("lo"), F.greatest("ca", "cb").alias("hi")).agg(best).select("p.*"), name)
            found = saved(verify(best).select("a", "b"), name)
            links = found if links is None else links.union(found)
            comp = _merged(comp, found, name)
            at = comp.select(F.col("node").alias("a"), F.col("component").alias("ca"))
            to = comp.select(F.col("node").alias("b"), F.col("component").alias("cb"))
            pairs = pairs.select("a", "b").join(best, ["a", "b"], "left_anti").join(at, "a").join(to, "b").filter("ca != cb").select("a", "b")
            pairs = saved(pairs, name)
        found = saved(verify(pairs).select("a", "b"), name)
        links = found if links is None else links.union(found)
        comp = _merged(comp, found, name)
    if links is None:
        links = members.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    return comp, links


def _left_over(left: DataFrame, comp: DataFrame, seen: DataFrame | None, metric: Metric | None, name: str) -> DataFrame:
    """Pairs (a, b) of different components that share a group and may link."""
    sizes = saved(comp.groupBy("component").agg(F.count("*").alias("of")), name)
    sized = left.join(sizes, "component")
    here = sized.groupBy("key", F.col("component").alias("other"), F.col("of").alias("others")).agg(F.max("early").alias("met"))
    first = F.struct("of", "component") < F.struct(F.col("others").alias("of"), F.col("other").alias("component"))
    meets = saved(sized.join(here, "key").filter(first).filter("early = 1 or met = 1").select("node", "other", "others").distinct(), name)
    pair = [F.least("node", "member").alias("a"), F.greatest("node", "member").alias("b")]
    alone = meets.filter("others = 1").select("node", F.col("other").alias("member"))
    many = meets.filter("others > 1").select("node", "other")
    held = comp.select(F.col("component").alias("other"), F.col("node").alias("member"))
    if metric is None:
        pairs = many.join(held, "other").select("node", "member")
    else:
        slack = metric.limit + 1e-9
        within = saved(held.join(many.select("other").distinct(), "other", "left_semi"), name)
        apart = metric.exact(within.filter("member != other").select(F.col("other").alias("a"), F.col("member").alias("b")))
        apart = apart.select(F.col("a").alias("other"), F.col("b").alias("member"), F.col("d").alias("own"))
        apart = saved(apart.union(within.select("other", F.col("other").alias("member"), F.lit(0.0).alias("own")).distinct()), name)
        reach = saved(apart.groupBy("other").agg(F.max("own").alias("reach")), name)
        ends = [F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")]
        near = saved(many.join(small(reach), "other").select(*ends, "node", "other", "reach"), name)
        near = metric.least(near).filter(F.col("least") <= F.col("reach") + slack)
        near = metric.exact(saved(near.select("a", "b", "node", "other", "reach"), name)).filter(F.col("d") <= F.col("reach") + slack)
        near = saved(near.select("node", "other", "d"), name)
        pairs = near.join(apart, "other").filter(F.abs(F.col("d") - F.col("own")) <= slack).select("node", "member")
    pairs = alone.union(pairs).select(*pair).distinct()
    if seen is not None:
        pairs = pairs.join(seen, ["a", "b"], "left_anti")
    return saved(pairs, name)
