"""Exact n-gram Jaccard join in the metric space of shingle sets, and its groups.

Two documents link when their sets of word shingles have a Jaccard similarity of at least `percent` / 100, that is a
Jaccard distance of at most r = 1 - percent / 100. Jaccard distance is a metric, so regions around pivots can be joined one by one:

1. Pivots of the first level are the shingles themselves, as one-element sets. A document x is at distance 1 - 1/|x| from each
   of its shingles and at distance 1 from any other, so it belongs to the Voronoi region of its first shingle in a fixed order of
   all shingles. (Documents as pivots don't part a corpus: nearly all pairs of documents are at distance 1.)
2. Windows: a document within r of x has lost at most floor(r |x|) of x's shingles, so one of x's first floor(r |x|) + 1
   shingles in that order is among the other's first ones as well. x is copied to those regions, and to no more; that every link
   lies in a common region follows. The first of the shared shingles stands earlier still in the smaller set: among its first
   floor((1 - 2 s / (1 + s)) n) + 1, where s = 1 - r. So of two documents in a region one must be there by such an early shingle.
   From the empty set as another pivot, distances under symmetric difference are sizes; within a region, documents are cut into
   windows where the next size is beyond the ratio that a link allows.
3. The order puts shingles that many documents hold last (counted over all documents, a batch at a time), so that frequent lines
   make no large regions. Any order gives the same links.
4. Windows of regions join exactly: small ones pair by pair, larger ones by document pivots (``link_groups``): families of near copies
   come together around a pivot each, then a document meets a family only in the window of distances from its pivot that the
   triangle inequality leaves. A pair is first bounded from sketches: a sketch holds for each of
   `BITS` classes of shingles (more for large sets) whether their number is odd, so two sketches differ in no more bits than the sets in shingles. Pairs
   that the bound leaves are verified on whole sets.

Equal sets are one node from the start. Defined results: null, empty and word-free texts have an empty set and link with nothing, not
even with each other; fewer words than a shingle has are one shingle; rows with a null id form their own components, with null
component_id; repeated rows come back as often; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix64, partitions, saved, shingle_hashes, slices, small, table, text_bytes, word_hashes
from .linking import SMALL_GROUP, Metric, components, link_groups

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_PIECE = 1 << 20
#: A shingle that more different documents of a batch hold than this is counted as frequent.
BATCH_LEAST = 2
#: Bits of a set's sketch at least. A larger set has twice as many until it has as many bits as shingles.
BITS = 1024
#: Most frequent shingles that are ranked last; it bounds what is broadcast and changes no result.
RANKED_LAST = 200_000


def shingle_set(text: str | None, k: int, lower: bytes = _LOWER, space: np.ndarray = _SPACE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's k-word shingles."""
    raw = text_bytes(text).translate(lower)
    data = np.frombuffer(raw, np.uint8)
    parts, at = [], 0
    while at < len(data):
        end = min(at + _PIECE, len(data))
        while end < len(data) and not space[data[end]]:
            end += 1
        parts.append(word_hashes(data[at:end], space)[0])
        at = end
    words = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return np.unique(shingle_hashes(words, k))


def as_lists(sets: list[np.ndarray]) -> pa.ListArray:
    """One list of signed numbers for each set of hashes."""
    ends = np.cumsum([0, *map(len, sets)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)))


def _node(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(s: np.ndarray) -> bytes:
    """For each class of shingles (by their last bits), whether their number is odd."""
    width = max(BITS, 1 << max(len(s) - 1, 0).bit_length())
    odd = np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def differing(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """In how many bits the sketches differ, pair by pair. The classes of a wider one are joined until it is as wide as the other."""
    out = np.zeros(len(x), np.int64)
    widths = np.array([(len(a), len(b)) for a, b in zip(x, y, strict=True)])
    for wide, narrow in np.unique(np.sort(widths, axis=1)[:, ::-1], axis=0):
        some = np.flatnonzero((widths.max(axis=1) == wide) & (widths.min(axis=1) == narrow))
        ends = [(x[i], y[i]) if len(x[i]) >= len(y[i]) else (y[i], x[i]) for i in some]
        a, b = (np.frombuffer(b"".join(e[j] for e in ends), np.uint64).reshape(len(some), -1) for j in (0, 1))
        while a.shape[1] > b.shape[1]:
            half = a.shape[1] // 2
            a = a[:, :half] ^ a[:, half:]
        out[some] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return out


def set_sizes(docs: DataFrame, k: int, shingles=shingle_set) -> DataFrame:
    """(id, n, node, bits, hot, times): each row's set size, hash and sketch; a batch's frequent shingles and their counts, on its last row."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, node, bits, group, total = [], [], [], [], 0
            hot: dict[int, int] = {}
            held = set()

            def count() -> None:
                s, c = np.unique(np.concatenate(group), return_counts=True)
                for a, b in zip(s[c > 1].tolist(), c[c > 1].tolist(), strict=True):
                    hot[a] = hot.get(a, 0) + b

            for text in batch.column(1).to_pylist():
                s = shingles(text, k)
                n.append(len(s))
                node.append(_node(s))
                bits.append(sketch(s))
                if len(s) and node[-1] not in held:
                    held.add(node[-1])
                    group.append(s)
                    total += len(s)
                    if total > 500_000:
                        count()
                        group, total = [], 0
            if group:
                count()
            often = sorted((np.uint64(s).astype(np.int64).item(), c) for s, c in hot.items() if c > BATCH_LEAST)
            blank = [None] * (len(n) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(bits, pa.binary()), pa.array([*blank, [s for s, _ in often]], pa.list_(pa.int64())), pa.array([*blank, [c for _, c in often]], pa.list_(pa.int64()))],
                names=["id", "n", "node", "bits", "hot", "times"],
            )

    return docs.mapInArrow(run, f"id {kind}, n long, node long, bits binary, hot array<long>, times array<long>")


def _regions(docs: DataFrame, k: int, percent: int, last: np.ndarray, shingles=shingle_set) -> DataFrame:
    """(key, n, node, early): the sets of (text) rows in the regions of their first floor(r n) + 1 shingles, once a batch each. early: 1 for
    the first of these, as many as a link to a set of at least this size leaves for the first shingle that both have."""
    share = docs.sparkSession.sparkContext.broadcast(last)  # at most RANKED_LAST numbers, the most frequent last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.argsort(share.value, kind="stable")
        known = share.value[place]
        for batch in batches:
            held: set[int] = set()
            for lo, hi in slices(batch, "text"):  # a few million characters at a time
                yield from regions(batch.column(0).slice(lo, hi - lo).to_pylist(), held, place, known)

    def regions(texts: list[str | None], held: set[int], place: np.ndarray, known: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, sizes, nodes, early = [], [], [], []
        for text in texts:
            s = shingles(text, k)
            n = len(s)
            if not n or (node := _node(s)) in held:
                continue
            held.add(node)
            first = n * (100 - percent) // 100 + 1
            if len(known):
                at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                often = known[at] == s
                late = s[often][np.argsort(place[at[often]], kind="stable")]
                s = np.concatenate((s[~often], late))
            keys.append(s[:first].view(np.int64))
            sizes.append(np.full(first, n))
            nodes.append(np.full(first, node))
            early.append((np.arange(first) <= n + (-2 * percent * n) // (100 + percent)).astype(np.int64))
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, sizes, nodes, early)], names=["key", "n", "node", "early"])

    return docs.select("text").mapInArrow(run, "key long, n long, node long, early long")


def _candidates(rows: DataFrame, percent: int) -> DataFrame:
    """(large, a, b, early): the pairs of nodes of each small window of a region; of a large one its members, as (window, node).

    Two nodes are a pair only if one is in the region by an early shingle (see ``_regions``).

    A region's rows come sorted by size and are cut into windows where the next size is beyond the ratio that links allow. They
    are read in a stream that holds the rows of one small window or the last row of a large one."""
    rows = rows.repartition(partitions(rows), "key").sortWithinPartitions("key", "n", "node")
    places = {s: np.triu_indices(s, 1) for s in range(2, SMALL_GROUP + 1)}

    def give(pairs: list[np.ndarray], members: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for large, parts in ((False, pairs), (True, members)):
            if parts:
                got = np.concatenate(parts)
                got = got if large else np.column_stack((u := np.unique(got, axis=0), np.ones(len(u), np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), large)), *(pa.array(c) for c in got.T)], names=["large", "a", "b", "early"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 4), np.int64)  # rows (key, n, node, early) of the last window: all, or the last one if it is large
        window = None  # the number of a large last window
        for batch in batches:
            now = np.concatenate((held, np.column_stack([c.to_numpy() for c in batch.columns])))
            held, window, pairs, members = step(now, window, False)
            yield from give(pairs, members)
        _, _, pairs, members = step(held, window, True)
        yield from give(pairs, members)

    def step(now: np.ndarray, window: int | None, over: bool):
        if not len(now):
            return now, window, [], []
        other = np.ones(len(now), bool)  # repeated sets stand together
        other[1:] = (now[1:, 0] != now[:-1, 0]) | (now[1:, 2] != now[:-1, 2])
        now = now[other]
        key, n, node, early = now.T
        start = np.ones(len(now), bool)
        start[1:] = (key[1:] != key[:-1]) | (n[1:] * percent > n[:-1] * 100)
        first = np.flatnonzero(start)
        size = np.diff(np.append(first, len(now)))
        name = mix64(key[first].view(np.uint64) * np.uint64(31) + n[first].astype(np.uint64)).view(np.int64)
        pairs, members, known = [], [], window is not None
        if known:
            name[0] = window
            members.append(np.column_stack((np.full(size[0] - 1, window), node[1 : size[0]], early[1 : size[0]])))  # its last row was given before
        last = len(first) - 1
        done = np.arange(len(first)) if over else np.arange(last)
        done = done[1:] if known else done
        for s, (i, j) in places.items():
            at = first[done[size[done] == s]]
            if len(at):
                x, y = at[:, None] + i, at[:, None] + j
                near = (n[y] * percent <= n[x] * 100) & ((early[x] | early[y]) == 1)
                x, y = node[x[near]], node[y[near]]
                pairs.append(np.column_stack((np.minimum(x, y), np.maximum(x, y))))
        for w in done[size[done] > SMALL_GROUP]:
            members.append(np.column_stack((np.full(size[w], name[w]), node[first[w] : first[w] + size[w]], early[first[w] : first[w] + size[w]])))
        if over:
            return now[:0], None, pairs, members
        if known and last == 0:
            return now[-1:], window, pairs, members
        if size[last] > SMALL_GROUP:
            members.append(np.column_stack((np.full(size[last], name[last]), node[first[last] :], early[first[last] :])))
            return now[-1:], int(name[last]), pairs, members
        return now[first[last] :], None, pairs, members

    return rows.mapInArrow(run, "large boolean, a long, b long, early long")


def _sets(texts: DataFrame, k: int, shingles=shingle_set) -> DataFrame:
    """(node, members) of (text) rows: whole sets of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, (lo, hi) in ((b, s) for b in batches for s in slices(b, "text")):
            made = [shingles(t, k) for t in batch.column(0).slice(lo, hi - lo).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in made], pa.int64()), as_lists(made)], names=["node", "members"])

    return texts.select("text").mapInArrow(run, "node long, members array<long>")


def least_distance(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Saved pairs (a, b, ...) with least: a lower bound of their Jaccard distance, from sketches (node, n, bits)."""
    given, pairs = pairs.schema, small(pairs)
    for end, other in (("a", "_x"), ("b", "_y")):
        pairs = pairs.join(sketches.select(F.col("node").alias(end), F.col("n").alias(f"_n{other}"), F.col("bits").alias(other)), end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("_n_x").to_numpy() + batch.column("_n_y").to_numpy()
            apart = differing(batch.column("_x").to_pylist(), batch.column("_y").to_pylist())
            most = np.minimum((n - apart) // 2, np.minimum(batch.column("_n_x"), batch.column("_n_y")))  # shingles that both can hold
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in given.names), pa.array(1 - most / (n - most))], names=[*given.names, "least"])

    return pairs.select(*given.names, "_n_x", "_n_y", "_x", "_y").mapInArrow(run, T.StructType([*given.fields, T.StructField("least", T.DoubleType())]))


def bounded(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that can link as far as their sketches (node, n, bits) tell."""
    near = least_distance(pairs, sketches).filter(F.col("least") <= 1 - percent / 100 + 1e-9)
    return saved(near.select("a", "b"), "bounded")


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Saved pairs (a, b, ...) with both and d: how many shingles their sets (node, members) share, and their Jaccard distance.

    Whole sets are met a row at a time in the JVM; batches of them for Python would have no bound in bytes."""
    given = pairs.columns
    # pairs that can be broadcast spare the first shuffle of sets; of the others only those go that stand in a pair
    pairs = small(pairs)
    with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("_x")), "a")
    ends = small(pairs.select("b").distinct())
    others = sets.select(F.col("node").alias("b"), F.col("members").alias("_y")).join(ends, "b", "left_semi")
    both = F.size(F.array_intersect("_x", "_y")).cast("long")
    met = with_a.join(others, "b").select(*given, both.alias("both"), (F.size("_x") + F.size("_y")).cast("long").alias("n"))
    either = F.col("n") - F.col("both")
    return met.select(*given, "both", either.alias("either"), (1 - F.col("both") / F.greatest(either, F.lit(1))).alias("d"))


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets (node, members) have 100 * |a & b| >= percent * |a | b|."""
    told = distances(pairs.select("a", "b"), sets)
    return told.filter((F.col("both") > 0) & (F.col("both") * 100 >= F.col("either") * percent)).select("a", "b").distinct()


def similar_groups(docs: DataFrame, k: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", shingles=shingle_set) -> DataFrame:
    """(id, n_shingles, component_id) of every row; component_id is the smallest id that can be reached by links."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sized = saved(set_sizes(rows, k, shingles), "sets")
    often = sized.filter("size(hot) > 0").select(F.explode(F.arrays_zip("hot", "times")).alias("h"))
    often = often.groupBy(F.col("h.hot").alias("s")).agg(F.sum("h.times").alias("c")).orderBy(F.desc("c"), "s").limit(RANKED_LAST).toArrow()
    last = often.column("s").to_numpy().view(np.uint64)[::-1].copy()
    found = saved(_candidates(_regions(rows, k, percent, last, shingles), percent), "candidates")
    members = found.filter("large").select(F.col("a").alias("key"), F.col("b").alias("node"), "early")
    pairs = saved(found.filter("not large").select("a", "b").distinct(), "pairs")
    ends = lambda p: p.select(F.explode(F.array("a", "b")).alias("node"))
    nodes = saved(ends(pairs).union(members.select("node")).distinct(), "nodes")
    sketches = saved(sized.join(nodes, "node").groupBy("node").agg(F.first("n").alias("n"), F.first("bits").alias("bits")), "sketches")
    pairs = bounded(pairs, sketches, percent)
    classes = sized.filter("n > 0").groupBy("node").agg(F.min("id").alias("first"))
    wanted = classes.join(ends(pairs).union(members.select("node")).distinct(), "node").filter("first is not null")
    texts = rows.join(small(saved(wanted.select("first"), "wanted")), F.col("id") == F.col("first"))
    whole = saved(_sets(texts, k, shingles), "whole-sets")
    # links of small windows, then what large ones add
    links = saved(linked(pairs, whole, percent), "links")
    if not members.isEmpty():
        metric = Metric(lambda p: distances(p, whole), lambda p: least_distance(p, sketches), 1 - percent / 100)
        links = links.union(link_groups(members, lambda p: linked(bounded(p, sketches, percent), whole, percent), metric=metric)[1])
    comp = components(links)
    at = classes.join(comp, "node", "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    named = at.join(at.groupBy("component").agg(F.min("first").alias("component_id")), "component").select("node", "component_id")
    out = sized.select("id", "n", "node").join(named, "node", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by 4-word shingles at a Jaccard similarity of 0.85."""
    return similar_groups(table(spark, sf_dir, "documents"))
