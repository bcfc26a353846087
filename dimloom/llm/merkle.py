"""Merkle manifest of a table: a digest tree for each source, one over their roots, and a proof for each row.

H is the lowercase hex sha256 of its inputs put together. A leaf is H of a row's fields, each `-` if null, else its UTF-8 byte
count, `:` and its value. The leaves of a source stand by id; every 16 neighbours become their H, level by level, until one node,
the source's subroot, is left. The subroots, by source (null first, bytewise), are the leaves of the top tree, whose end is the root.

1. Leaves are hashed once, written, and numbered by one range sort over (source, id, leaf); no window over a source.
2. Each level is one grouping by (tree, place div 16) of at most 16 digests. Built levels are stored as rows that name their parent.
3. Proofs come from a recursive query over the stored rows. A row of it is a run of at most 16 leaves: at every step each leaf's own
   folded digest is hashed with the siblings of the node it stands for, and these siblings, the same for the whole run, are appended once.
   The first step, inside the run, has other siblings for each leaf and is done when the run is gathered.
4. All runs of a source meet in its upper nodes. A node with many runs below it is stored once for each `RUNS_A_COPY` of them, and a
   run joins the copy that its hash names, so no key of the join grows with a source.

Defined results: nulls and empty texts have digests like any value; rows of equal id stand by leaf, and equal rows (whose proofs can
differ only by the place that each has) are leaves each; an empty table gives no rows; columns other than the fields aren't read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import number_rows
from .common import saved, small, table

FANOUT = 16
#: Runs of leaves that join one copy of a node.
RUNS_A_COPY = 4096
#: Tree number of the tree over subroots.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_CLIMB = """
WITH RECURSIVE climb (tree, at, up_tree, up_level, up_at, place, salt, subroot, folded, beside) AS (
  SELECT tree, at, up_tree, up_level, up_at, place, salt, subroot, folded, beside FROM {runs}
  UNION ALL
  SELECT c.tree, c.at, n.up_tree, n.up_level, n.up_at, n.place, pmod(xxhash64(c.tree, c.at), n.up_copies),
    CASE WHEN n.tree = -1 AND n.level = 1 THEN substr(n.kids, 64 * c.place + 1, 64) ELSE c.subroot END,
    transform(c.folded, f -> sha2(concat(substr(n.kids, 1, 64 * c.place), f, substr(n.kids, 64 * c.place + 65)), 256)),
    concat(c.beside, substr(n.kids, 1, 64 * c.place), substr(n.kids, 64 * c.place + 65))
  FROM climb c JOIN {nodes} n ON n.tree = c.up_tree AND n.level = c.up_level AND n.at = c.up_at AND n.salt = c.salt)
SELECT tree, at, subroot, folded, beside FROM climb WHERE up_level IS NULL"""


def digest(values: list[Column]) -> Column:
    """H of typed values."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _copies(below: Column) -> Column:
    return F.ceil(below / RUNS_A_COPY).cast("long")


def _link(level: int, left: Column, tree: Column, at: Column, top_copies: Column, many: bool) -> list[Column]:
    """A node's parent: in its own tree while others are left on its level, else in the tree over subroots, if there is one."""
    own, none = left > 1, F.lit(None)
    up = lambda inner, outer: F.when(own, inner).otherwise(outer if many else none)
    return [
        up(tree, F.lit(TOP)).cast("long").alias("up_tree"), up(F.lit(level + 1), F.lit(1)).cast("int").alias("up_level"),
        up(F.floor(at / FANOUT), F.floor(tree / FANOUT)).cast("long").alias("up_at"),
        up(at % FANOUT, tree % FANOUT).cast("int").alias("place"),
        up(F.lit(-(-(FANOUT**level) // RUNS_A_COPY)), top_copies).cast("long").alias("up_copies"),
    ]


def _gathered(rows: DataFrame, *carry: str) -> DataFrame:
    """(tree, at, *carry, kids): each run of at most 16 nodes (tree, at, hash), with its digests put together."""
    runs = rows.groupBy("tree", F.floor(F.col("at") / FANOUT).alias("up"), *carry)
    got = runs.agg(F.sort_array(F.collect_list(F.struct("at", "hash"))).alias("run"))
    return got.select("tree", F.col("up").alias("at"), *carry, F.array_join("run.hash", "").alias("kids"))


def _runs(leaves: DataFrame, groups: DataFrame, many: bool) -> DataFrame:
    """Level 1, one row a run of leaves: its members, its digest, each member's folded digest and own siblings, its parent."""
    own = groups.select("tree", "start", "n", "top_copies", F.col("grp").alias("__grp"))
    placed = leaves.join(small(own), leaves["grp"].eqNullSafe(F.col("__grp"))).withColumn("at", F.col("__at") - F.col("start"))
    member = F.struct("at", "id", "leaf", "tampered")
    runs = placed.groupBy("tree", F.floor(F.col("at") / FANOUT).alias("up"), "n", "top_copies").agg(F.sort_array(F.collect_list(member)).alias("m"))
    kids = F.array_join("m.leaf", "")
    beside = F.transform("m", lambda x, i: F.concat(F.substr("kids", F.lit(1), i * 64), F.substr("kids", i * 64 + 65)))
    fold = lambda x, i: F.sha2(F.concat(F.substr("kids", F.lit(1), i * 64), F.coalesce(x["tampered"], x["leaf"]), F.substr("kids", i * 64 + 65)), 256)
    lone = F.col("n") == 1
    rows = runs.select("tree", F.col("up").alias("at"), "n", "top_copies", "m", kids.alias("kids"))
    rows = rows.withColumns({
        "left": F.ceil(F.col("n") / FANOUT),
        "hash": F.when(lone, F.col("kids")).otherwise(F.sha2("kids", 256)),
        "own": beside,
        "folded": F.when(lone, F.transform("m", lambda x: F.coalesce(x["tampered"], x["leaf"]))).otherwise(F.transform("m", fold)),
    })
    link = _link(1, F.col("left"), F.col("tree"), F.col("at"), F.col("top_copies"), many)
    return rows.select("tree", "at", "left", "top_copies", "hash", "m", "own", "folded", *link)


def manifest(docs: DataFrame, tampered: Column, altered: dict[str, Column], id_col: str = "doc_id", group_col: str = "source", fields=FIELDS) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``tampered``: which rows are checked with the columns of ``altered`` in place of their own."""
    spark = docs.sparkSession
    changed = digest([altered.get(f, F.col(f)) for f in fields])
    leaves = docs.select(
        F.col(group_col).alias("grp"), F.col(id_col).alias("id"), digest([F.col(f) for f in fields]).alias("leaf"),
        F.when(tampered, changed).alias("tampered"),
    )
    numbered = number_rows(saved(leaves, "leaves"), ["grp", "id", "leaf", "tampered"], "__at")
    sources = saved(numbered.df.groupBy("grp").agg(F.min("__at").alias("start"), F.count("*").alias("n")), "sources")
    found = number_rows(sources, ["grp"], "tree")
    trees, most = found.rows, sources.agg(F.max("n")).first()[0]
    kinds = f"{id_col} {leaves.schema['id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if not trees:
        return spark.createDataFrame([], kinds)
    # runs below each node of the top tree, level by level: these say how often it is copied
    below = [found.df.select(F.col("tree").alias("at"), F.ceil(F.col("n") / FANOUT).alias("runs"))]
    for _ in range(_height(trees)):
        below.append(saved(below[-1].groupBy(F.floor(F.col("at") / FANOUT).alias("at")).agg(F.sum("runs").alias("runs")), "below"))
    copies = [b.select(F.col("at").alias("__block"), _copies(F.col("runs")).alias("__copies")) for b in below]
    many = trees > 1
    groups = found.df.withColumn("top_copies", F.lit(None).cast("long"))
    if many:
        blocks = found.df.join(copies[1], F.floor(F.col("tree") / FANOUT) == F.col("__block"))
        groups = blocks.select(*found.df.columns, F.col("__copies").alias("top_copies"))
    runs = saved(_runs(numbered.df, saved(groups, "groups"), many), "runs")

    nodes, subroots, level, now = [], [], 1, runs.select("tree", "at", "left", "top_copies", "hash")
    for level in range(1, max(1, _height(most)) + 1):
        subroots.append(now.filter("left = 1").select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("at"), "hash"))
        if FANOUT**level >= most:
            break
        up = _gathered(now.filter("left > 1"), "left", "top_copies").withColumn("left", F.ceil(F.col("left") / FANOUT))
        link = _link(level + 1, F.col("left"), F.col("tree"), F.col("at"), F.col("top_copies"), many)
        n = -(-(FANOUT**level) // RUNS_A_COPY)
        now = saved(up.select("tree", F.lit(level + 1).alias("level"), "at", "left", "top_copies", "kids", F.sha2("kids", 256).alias("hash"), F.lit(n).cast("long").alias("copies"), *link), "level")
        nodes.append(now)
    now = reduce(DataFrame.union, subroots)
    for level in range(1, len(below)):
        up = _gathered(now).join(copies[level], F.col("at") == F.col("__block")).withColumnRenamed("__copies", "copies").drop("__block")
        last = level + 1 == len(below)
        if not last:
            up = up.join(copies[level + 1], F.floor(F.col("at") / FANOUT) == F.col("__block"))
        link = _link(level, F.lit(1 if last else 2), F.col("tree"), F.col("at"), F.lit(None), False)[:-1]
        link.append((F.lit(None) if last else F.col("__copies")).cast("long").alias("up_copies"))
        now = saved(up.select("tree", F.lit(level).alias("level"), "at", F.lit(1).cast("long").alias("left"), F.lit(None).cast("long").alias("top_copies"), "kids", F.sha2("kids", 256).alias("hash"), "copies", *link), "level")
        nodes.append(now)
    root = now.select("hash").first()[0]  # of one row: the last level's
    start = runs.withColumn("salt", F.pmod(F.xxhash64("tree", "at"), F.col("up_copies")))
    start = start.withColumn("subroot", F.when(F.col("left") == 1, F.col("hash"))).withColumn("beside", F.lit(""))
    if nodes:
        stored = reduce(DataFrame.union, nodes).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        climbed = _climb(spark, start, small(saved(stored, "nodes")))
    else:
        climbed = start.select("tree", "at", "subroot", "folded", "beside")
    parts = runs.select("tree", "at", "m", "own").join(climbed, ["tree", "at"])
    zipped = F.explode(F.arrays_zip("m", "own", "folded")).alias("x")
    rows = parts.select(zipped, F.coalesce("subroot", F.lit(root)).alias("subroot"), "beside")
    rows = rows.select(F.col("x.m.id").alias("id"), F.col("x.m.leaf").alias("leaf"), "subroot", F.lit(root).alias("root"),
                       F.sha2(F.concat("x.own", "beside"), 256).alias("proof_sha256"), F.col("x.folded").alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root")).withColumnRenamed("id", id_col)


def _height(leaves: int) -> int:
    """Levels above so many leaves."""
    n = 0
    while leaves > 1:
        leaves, n = -(-leaves // FANOUT), n + 1
    return n


def _climb(spark: SparkSession, start: DataFrame, nodes: DataFrame) -> DataFrame:
    """The recursive query's last rows. Spark's limit on the rows of such a query (one for each run and level) is off while it runs."""
    setting = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "-1")
    try:
        return saved(spark.sql(_CLIMB, runs=start, nodes=nodes), "climbed")
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of documents, checked with a lower-cased text where 5 divides the id's crc32."""
    where = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(docs, F.coalesce(where, F.lit(False)), {"text": lower_ascii(F.col("text"))})


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether its (in part tampered) text folds to the root."""
    return tampered_manifest(table(spark, sf_dir, "documents"))


#: The same from the definition: crc32 bit by bit, trees by grouping level by level, a climb for each leaf.
OP12_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda crc, b:
      list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 5 = 0 AS tampered
  FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(CASE WHEN tampered THEN lowered ELSE text END) || ':' || CASE WHEN tampered THEN lowered ELSE text END, '-')) AS shown
  FROM d),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves),
up AS (
  SELECT source, 0 AS lvl, pos, leaf AS hash, n FROM placed
  UNION ALL
  SELECT source, lvl + 1, pos // 16, sha256(string_agg(hash, '' ORDER BY pos)), (n + 15) // 16 FROM up WHERE n > 1 GROUP BY source, lvl, pos // 16, n),
sources AS (SELECT source, hash AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS lvl, pos, subroot AS hash, n FROM sources
  UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(hash, '' ORDER BY pos)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY lvl, pos // 16, n),
nodes AS (
  SELECT s.pos AS tree, u.lvl, u.pos, u.hash, u.n FROM up u JOIN sources s ON s.source IS NOT DISTINCT FROM u.source
  UNION ALL SELECT -1, lvl, pos, hash, n FROM top),
beside AS (
  SELECT tree, lvl, pos, n,
    coalesce(string_agg(hash, '') OVER (PARTITION BY tree, lvl, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(hash, '') OVER (PARTITION BY tree, lvl, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes),
climb AS (
  SELECT p.doc_id, p.leaf, s.pos AS source_pos, s.subroot, p.pos AS leaf_pos, s.pos AS tree, 0 AS lvl, p.pos, shown AS folded, '' AS proof
  FROM placed p JOIN sources s ON s.source IS NOT DISTINCT FROM p.source
  UNION ALL
  SELECT doc_id, leaf, source_pos, subroot, leaf_pos, CASE WHEN b.n = 1 THEN -1 ELSE c.tree END, CASE WHEN b.n = 1 THEN 0 ELSE c.lvl + 1 END,
    CASE WHEN b.n = 1 THEN source_pos ELSE c.pos // 16 END, CASE WHEN b.n = 1 THEN folded ELSE sha256(l || folded || r) END, CASE WHEN b.n = 1 THEN proof ELSE proof || l || r END
  FROM climb c JOIN beside b ON b.tree = c.tree AND b.lvl = c.lvl AND b.pos = c.pos WHERE b.n > 1 OR c.tree >= 0)
SELECT c.doc_id, c.leaf, c.subroot, t.hash AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = t.hash AS verified
FROM climb c JOIN (SELECT lvl, hash FROM top WHERE n = 1) t ON c.tree = -1 AND c.lvl = t.lvl
"""
