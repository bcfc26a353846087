"""Near-duplicate vectors: exact links by cosine within a label, from int8 products of tiles.

1. Vectors are sorted by (label, length, nearest of `DIRECTIONS` fixed directions, twice) into blocks. Equal neighbours become one vector with a
   count; a large group of copies may span blocks, where its members meet as vectors of cosine 1.
2. A block knows its centre and radius (largest angle to the centre). Two blocks of a label meet unless the triangle inequality
   of angles shows that no pair of theirs can link. The list of blocks that meet is joined from these few numbers alone.
3. Where two blocks meet, each vector is quantised, u = s q + e with q of int8. Then |u.v - s t q.r| <= |e| + (1 + |e|) |f|, so a tile
   of integer products, exact in float32, shows which pairs may reach the threshold. Only these are computed again in double precision.
4. A task returns for each linked vector the number of its links there (copies counted) and its smallest relative in a spanning forest, so a
   group of n near copies gives n rows and not n * n pairs. Sums over tasks and components of the forests give the result.

The work is that of all pairs of a label that the angles leave; a block is sent once to each block that it meets. Nothing is capped.

Defined results: vectors that are null, zero, or hold null or non-finite entries, and rows with a null label, link with nothing and
are their own component; vectors of different lengths don't link; rows of equal id are vectors each, and rows that carry the component's id
are all kept; rows with a null id take part, a component of such rows alone has a null id and keeps them all; an empty table gives no rows;
other columns aren't read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, small, table
from .linking import components
from .vectors import by_length, vectors

#: Entries of a block's vectors; rows of a block that are worth a task of their own in a small table.
BLOCK_ENTRIES, BLOCK_LEAST = 1 << 22, 1 << 13
#: Rows of a tile.
TILE = 2048
DIRECTIONS = 64
#: Added to bounds for rounding: of float32 products and of angles.
SLACK = 1e-5
#: Inner dimensions whose int8 products sum exactly in float32.
EXACT_WIDTH = 1024


@functools.lru_cache(8)
def _directions(n: int) -> np.ndarray:
    return np.random.default_rng(n).standard_normal((n, 2 * DIRECTIONS))


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows at length 1; entries are first scaled by a power of two, so that no square over- or underflows."""
    _, power = np.frexp(np.abs(raw).max(axis=1, initial=0))
    raw = np.ldexp(raw, -power[:, None])
    return raw / np.sqrt((raw * raw).sum(axis=1))[:, None]


def quantised(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q, s, e): int8 codes, scales, and the length of the error that s * q leaves, rounded up."""
    s = np.abs(u).max(axis=1) / 127
    q = np.rint(u / s[:, None])
    e = np.sqrt(((u - s[:, None] * q) ** 2).sum(axis=1))
    return q.astype(np.int8), s, e * (1 + 1e-9) + 1e-12


def _rows(docs: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))


def _coded(rows: DataFrame) -> DataFrame:
    """(id, label, d, code, h, vector) of all rows: packed doubles, with a null vector where nothing can link."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            d, code, packed = np.zeros(n, np.int32), np.zeros(n, np.int32), np.full(n, None, object)
            labelled = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            for at, raw in by_length(*vectors(batch.column(2))):
                use = labelled[at] & (raw != 0).any(axis=1)
                at, raw = at[use], raw[use] + 0.0  # no -0.0
                if not len(at):
                    continue
                near = (unit(raw) @ _directions(raw.shape[1])).reshape(len(at), 2, DIRECTIONS)
                both = np.concatenate((near, -near), axis=2).argmax(axis=2)
                d[at], code[at] = raw.shape[1], both[:, 0] * 2 * DIRECTIONS + both[:, 1]
                for i, row in zip(at, raw):
                    packed[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(d), pa.array(code), pa.array(packed, pa.binary())], names=["id", "label", "d", "code", "vector"])

    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, d int, code int, vector binary")


def _blocks(coded: DataFrame, parts: int) -> DataFrame:
    """One row a block: label, d, number of its first vector, packed distinct vectors, their counts, centre, radius, members."""
    id_kind, label_kind = (coded.schema[c].dataType.simpleString() for c in ("id", "label"))
    keys = ["label", "d", "code", "h", "id"]
    rows = coded.withColumn("h", F.xxhash64("vector")).select(*keys, "vector")
    rows = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    columns = ["label", "d", "first", "vectors", "counts", "centre", "radius", "ids", "places"]

    def block(label: pa.Array, ids: pa.Array, raw: list[bytes], d: int, first: int) -> pa.RecordBatch:
        new = np.array([True, *(a != b for a, b in zip(raw[1:], raw))])
        place = np.cumsum(new) - 1
        distinct = b"".join(raw[i] for i in np.flatnonzero(new))
        u = unit(np.frombuffer(distinct).reshape(-1, d))
        centre, radius = ball(u)
        wrap = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        made = [label.slice(0, 1), pa.array([d], pa.int32()), pa.array([first], pa.int64()), pa.array([distinct], pa.binary()), pa.array([np.bincount(place).tobytes()], pa.binary()),
                wrap(pa.array(centre)), pa.array([radius]), wrap(ids), wrap(pa.array(place, pa.int32()))]
        return pa.RecordBatch.from_arrays(made, names=columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        held: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            done = 0
            for start, end, whole in _cuts(held):
                if not whole:
                    break
                made = one(held.slice(start, end - start), first)
                first, done = first + made[1], end
                yield made[0]
            held = held.slice(done)
        if held is not None and held.num_rows:
            for start, end, _ in _cuts(held):
                made = one(held.slice(start, end - start), first)
                first += made[1]
                yield made[0]

    def one(rows: pa.Table, first: int) -> tuple[pa.RecordBatch, int]:
        rows = rows.combine_chunks()
        col = lambda c: rows.column(c).combine_chunks() if rows.column(c).num_chunks != 1 else rows.column(c).chunk(0)
        made = block(col("label"), col("id"), col("vector").to_pylist(), rows.column("d")[0].as_py(), first)
        return made, made.column(8)[0][-1].as_py() + 1

    schema = f"label {label_kind}, d int, first long, vectors binary, counts binary, centre array<double>, radius double, ids array<{id_kind}>, places array<int>"
    return rows.mapInArrow(run, schema)


def _cuts(rows: pa.Table) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whole): runs of one label and length, of at most a block's rows; the last one may go on in rows to come."""
    d = rows.column("d").to_numpy()
    label = rows.column("label").combine_chunks().dictionary_encode()
    label = label.combine_chunks() if isinstance(label, pa.ChunkedArray) else label
    label = label.indices.to_numpy(zero_copy_only=False)
    edge = np.flatnonzero((d[1:] != d[:-1]) | (label[1:] != label[:-1])) + 1
    for start, end in zip([0, *edge], [*edge, len(d)]):
        most = max(1, BLOCK_ENTRIES // int(d[start]))
        for at in range(start, end, most):
            stop = min(at + most, end)
            yield at, stop, stop < len(d) or stop - at == most


def ball(u: np.ndarray) -> tuple[np.ndarray, float]:
    """A unit centre of unit vectors, and the largest angle to it."""
    centre = u.mean(axis=0)
    size = np.sqrt(centre @ centre)
    centre = centre / size if size > 1e-9 else u[0]
    return centre, float(np.arccos(np.clip(u @ centre, -1, 1).min()))


class _Block:
    def __init__(self, vectors: bytes, counts: bytes, d: int, first: int, row: int):
        self.unit = unit(np.frombuffer(vectors).reshape(-1, d))
        self.q, self.s, self.e = quantised(self.unit)
        self.count = np.frombuffer(counts, np.int64)
        self.first, self.row, self.n = first, row, len(self.unit)  # row: place of its vectors among those of the task
        self.tiles = [(i, min(i + TILE, self.n), *ball(self.unit[i : i + TILE])) for i in range(0, self.n, TILE)]


def _near(a: _Block, b: _Block, i: slice, j: slice, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile whose cosine is at least `least`."""
    x, y = a.q[i].astype(np.float32), b.q[j].astype(np.float32)
    if x.shape[1] <= EXACT_WIDTH:
        product = x @ y.T
    else:
        product = sum((x[:, c : c + EXACT_WIDTH] @ y[:, c : c + EXACT_WIDTH].T).astype(np.float64) for c in range(0, x.shape[1], EXACT_WIDTH))
    product *= a.s[i].astype(product.dtype)[:, None]
    product *= b.s[j].astype(product.dtype)[None, :]
    e = a.e[i]
    # s t q.r >= least - |e| - (1 + |e|) |f|, by the largest errors of the tile first
    loose = least - e.max() - (1 + e.max()) * b.e[j].max() - SLACK
    p, q = np.nonzero(product >= loose)
    close = product[p, q] >= least - e[p] - (1 + e[p]) * b.e[j][q] - SLACK
    p, q = p[close], q[close]
    if len(p) > 0.05 * product.size:
        exact = (a.unit[i] @ b.unit[j].T)[p, q]
    else:
        exact = np.concatenate([np.empty(0), *(np.einsum("ij,ij->i", a.unit[i][p[c : c + 65536]], b.unit[j][q[c : c + 65536]]) for c in range(0, len(p), 65536))])
    keep = exact >= least
    return p[keep], q[keep]


def _join_labels(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Unite the classes of x and y in root (each node's smallest known relative)."""
    while True:
        a, b = root[x], root[y]
        open_ = a != b
        if not open_.any():
            return
        x, y, a, b = x[open_], y[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, again := root[root]):
            root[:] = again


def meet(blocks: list[_Block], least: float) -> pa.RecordBatch:
    """Links within one block, or between two: (node, links, root) of each vector that has any."""
    n = sum(b.n for b in blocks)
    links, root = np.zeros(n, np.int64), np.arange(n)
    a, b = blocks[0], blocks[-1]
    limit = np.arccos(least) + SLACK
    for s, t, ca, ra in a.tiles:
        for u, v, cb, rb in b.tiles:
            if (a is b and u < s) or np.arccos(np.clip(ca @ cb, -1, 1)) > ra + rb + limit:
                continue
            p, q = _near(a, b, slice(s, t), slice(u, v), least)
            p, q = p + s, q + u
            if a is b:
                p, q = p[p < q], q[p < q]
            x, y = p + a.row, q + b.row
            for own, count in ((x, b.count[q]), (y, a.count[p])):
                links += np.bincount(own, weights=count, minlength=n).astype(np.int64)
            _join_labels(root, x, y)
    if a is b:
        links += a.count - 1
    node = np.concatenate([np.arange(b.first, b.first + b.n) for b in blocks])
    some = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some]), pa.array(node[root[some]])], names=["node", "links", "root"])


def similar_vectors(docs: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row: links of a cosine of at least `least` (above 0) between vectors of one label."""
    rows = _rows(docs, id_col, vector_col, label_col)
    size = rows.agg(F.count("*").alias("n"), F.sum(F.greatest(F.size("vector"), F.lit(0))).alias("entries")).first()
    spark, n, entries = docs.sparkSession, size["n"], size["entries"] or 0
    parts = max(-(-entries // BLOCK_ENTRIES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BLOCK_LEAST)), 1)
    coded = _coded(rows)
    blocks = saved(_blocks(coded.filter("vector is not null"), parts), "blocks")
    payload = ["d", "first", "vectors", "counts"]

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                d, first, v, c = (batch.column(i)[r].as_py() for i in range(4))
                yield meet([_Block(v, c, d, first, 0)], least)

    def across(pair: pa.Table) -> pa.Table:
        made: list[_Block] = []
        for r in pair.select(payload).to_pylist():
            made.append(_Block(r["vectors"], r["counts"], r["d"], r["first"], made[0].n if made else 0))
        return pa.Table.from_batches([meet(made, least)])

    ends = blocks.select("label", "d", "first", "centre", "radius")
    a, b = (ends.select("label", "d", F.col("first").alias(x), F.col("centre").alias(f"c{x}"), F.col("radius").alias(f"r{x}")) for x in "ab")
    cosine = F.aggregate(F.zip_with("ca", "cb", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    angle = F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0)))
    pairs = a.join(b, ["label", "d"]).filter("a < b").filter(angle <= F.col("ra") + F.col("rb") + float(np.arccos(least)) + SLACK)
    pairs = saved(pairs.select("a", "b"), "meetings")
    sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("first"))
    told = blocks.select(*payload).join(small(sides), "first").select("a", "b", *payload)
    out = "node long, links long, root long"
    found = blocks.select(*payload).mapInArrow(within, out).union(told.groupBy("a", "b").applyInArrow(across, out))
    found = saved(found, "found")

    members = blocks.select("first", F.explode(F.arrays_zip("ids", "places")).alias("m"))
    members = saved(members.select(F.col("m.ids").alias("id"), (F.col("first") + F.col("m.places")).alias("node")), "members")
    linked = components(found.filter("root != node").select(F.col("node").alias("a"), F.col("root").alias("b")))
    nodes = members.groupBy("node").agg(F.min("id").alias("id")).join(linked, "node", "left")
    nodes = saved(nodes.select("node", "id", F.coalesce("component", "node").alias("component"), F.col("component").isNotNull().alias("more")), "nodes")
    named = saved(nodes.filter("more").groupBy("component").agg(F.min("id").alias("component_id")), "named")
    several = nodes.filter("more").join(small(named), "component").select("node", "component_id")
    ids = several.union(nodes.filter("not more").select("node", F.col("id").alias("component_id")))
    counts = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    told = members.join(ids, "node").join(counts, "node", "left").select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "component_id")
    alone = coded.filter("vector is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = told.union(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    return out.withColumnRenamed("id", id_col)


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of embeddings of one label at a cosine of 0.98."""
    return similar_vectors(table(spark, sf_dir, "embeddings"))


#: The same from the definition: all pairs of a label, and what links reach.
OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_id AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN least_id r ON r.a = vec_id LEFT JOIN counted c ON c.a = vec_id
"""
