"""Best-fit packing of tokenized documents into sequences, after Martello-Toth dominance reduction.

Lengths are whole numbers from 1 to `capacity`, so an instance is a histogram of at most `capacity` counts, however
many documents there are. The plan is made on that histogram; documents are then dealt to the plan's places by their
rank among the pieces of their length, in parallel.

1. Pieces: each document's ids (and one end id) are cut into pieces only if longer than the capacity. Texts are
   tokenized chunk by chunk (chunks end at a space or newline, which this tokenizer drops), ids of recent chunks are kept.
2. Reduction (``reduce_instance``): a set of at most three lengths that holds the longest open length and dominates
   every other set holding it is fixed, as often as its counts allow; the instance shrinks, until no rule applies.
3. Best fit, longest first, packs the remainder (``best_fit``); each piece goes to the fullest sequence it fits.
4. Ranks: pieces are numbered per (length, salt) and salts get offsets from a table of counts, so a length that a third
   of all pieces share isn't one task's work.

Defined results: null and empty texts are the end id alone; repeated rows are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import saved, table

#: Most chunks whose ids a task keeps.
KEPT_CHUNKS = 1_000_000
SALTS = 32


#: Latin letters, then sentence punctuation: this tokenizer splits them there and lower-cases letter by letter.
_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")


class ChunkIds(dict):
    """chunk -> its ids as packed 32-bit numbers (little-endian), by the tokenizers library; emptied when it holds `most`."""

    def __init__(self, path: str, most: int = KEPT_CHUNKS):
        super().__init__()
        from tokenizers import Tokenizer, pre_tokenizers

        self.most, self.tokenizer = most, Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in (*range(97, 123), *range(0xDF, 0x100)) if chr(c).isalpha()]
        self.letters = str.maketrans({c: byte_level.pre_tokenize_str(c)[0][0] for c in letters})

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha() and chunk.islower():
            ids = array("I", [t.id for t in self.model.tokenize(chunk)]).tobytes()
        elif found := _WORD.fullmatch(chunk):
            word, marks = found.groups()
            lower = word.lower()
            if marks:
                ids = self[lower] + self[marks]
            elif lower != chunk:
                ids = self[lower]
            else:
                ids = array("I", [t.id for t in self.model.tokenize(lower.translate(self.letters))]).tobytes()
        elif chunk:
            ids = self._encode(chunk)
        else:
            return b""
        if len(chunk) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[chunk] = ids
        return ids

    def _encode(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def text(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" "))) if text else b""


@functools.cache
def chunk_ids(path: str) -> ChunkIds:
    """One table for each Python worker, which runs many tasks."""
    return ChunkIds(path)


def pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every piece of every row; one pass, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, width = chunk_ids(path), 4 * capacity
        for batch in batches:
            rows, piece, start, length, crc = [], array("q"), array("q"), array("q"), array("q")
            for i, t in enumerate(batch.column(1)):
                ids = chunks.text(t.as_py()) + end
                for n, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append(i)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                    names=["id", "piece", "start", "length", "ids_crc32"],
                )

    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(cut, f"id {kind}, piece int, start long, length long, ids_crc32 long")
    return out.withColumnRenamed("id", id_col)


class Plan:
    """Places for pieces by length and rank.

    A row (length, rank, count, per, bin, offset) places the pieces of that length with ranks rank .. rank+count-1, `per`
    in each sequence from number `bin` on, the first of them at `offset`."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.left = counts.astype(np.int64).copy()  # by length, 0 .. capacity
        self.taken = np.zeros_like(self.left)
        self.capacity, self.bins, self.rows = capacity, 0, []
        self.open: dict[int, list[tuple[int, int]]] = {}  # space left -> runs (first sequence, how many)

    def place(self, length: int, n_bins: int, per: int, first: int, offset: int) -> None:
        n = n_bins * per
        self.rows.append((length, int(self.taken[length]), n, per, first, offset))
        self.taken[length] += n
        self.left[length] -= n

    def fix(self, lengths: tuple[int, ...], times: int) -> None:
        """`times` new sequences that hold just these lengths."""
        first, offset = self.bins, 0
        self.bins += times
        for w in lengths:
            self.place(w, times, 1, first, offset)
            offset += w


def _largest(left: np.ndarray, most: int) -> int:
    """The largest length of at most `most` that has pieces, or 0."""
    if most <= 0:
        return 0
    at = np.flatnonzero(left[1 : most + 1])
    return int(at[-1]) + 1 if len(at) else 0


def reduce_instance(plan: Plan) -> None:
    """Fix dominating sets, longest length first, until none is left to fix.

    For an open length w let c = capacity - w and a be the largest length that fits beside one w. A set dominates another if
    the other's members can be split into groups, each of total at most a distinct member of the first (w matches w).
    * nothing fits: {w} is the only set.
    * a = c: any other set's further members total at most c = a, so {w, a} dominates.
    * no two fit beside w: every set is {w} or {w, x} with x <= a.
    * no three fit beside w and any two that fit total at most a: {w, a} dominates pairs and triples.
    * no three fit beside w, b is the largest that fits beside w and a, and each fitting pair x >= y has y <= b or
      x + y <= a: {w, a, b} dominates (x <= a and y <= b; or x and y both go to a).
    """
    cap, changed = plan.capacity, True
    while changed:
        changed = False
        for w in range(cap, 0, -1):
            while plan.left[w] > 0:
                found = _dominating(plan.left, w, cap)
                if not found:
                    break
                need = {x: found.count(x) for x in found}
                times = min(int(plan.left[x]) // n for x, n in need.items())
                plan.fix(found, times)
                changed = True


def _dominating(left: np.ndarray, w: int, cap: int) -> tuple[int, ...] | None:
    rest = left.copy()
    rest[w] -= 1
    c = cap - w
    a = _largest(rest, c)
    if a == 0:
        return (w,)
    if a == c:
        return (w, a)
    sizes = np.flatnonzero(rest[: c + 1])
    smallest = np.repeat(sizes[:3], np.minimum(rest[sizes[:3]], 3))[:3]
    if len(smallest) < 2 or smallest[0] + smallest[1] > c:
        return (w, a)
    if len(smallest) >= 3 and smallest.sum() <= c:
        return None
    # pairs that fit: for each y the largest x >= y with x + y <= c
    down = np.zeros(c + 1, np.int64)
    down[sizes] = sizes
    np.maximum.accumulate(down, out=down)
    best = down[c - sizes]
    twice = (best == sizes) & (rest[sizes] < 2)
    best[twice] = down[np.maximum(sizes[twice] - 1, 0)]
    ok = (best >= sizes) & (best > 0)
    x, y = best[ok], sizes[ok]
    if not len(x) or (x + y).max() <= a:
        return (w, a)
    rest[a] -= 1
    b = _largest(rest, c - a)
    if b and b <= a and bool(np.all((y <= b) | (x + y <= a))):
        return (w, a, b)
    return None


def best_fit(plan: Plan) -> None:
    """Best fit decreasing of what is left, in runs of sequences that have equally much space."""
    free = np.zeros(plan.capacity + 1, np.int64)  # open sequences by space left

    def put(space: int, first: int, n: int) -> None:
        if space and n:
            plan.open.setdefault(space, []).append((first, n))
            free[space] += n

    for w in range(plan.capacity, 0, -1):
        while (n := int(plan.left[w])) > 0:
            at = np.flatnonzero(free[w:])
            if len(at):
                space = int(at[0]) + w
                first, runs = plan.open[space].pop()
                free[space] -= runs
            else:
                space, runs = plan.capacity, -(-n // (plan.capacity // w))
                first = plan.bins
                plan.bins += runs
            per = space // w
            full = min(runs, n // per)
            offset = plan.capacity - space
            if full:
                plan.place(w, full, per, first, offset)
                put(space - full and space - per * w, first, full)
            more = n - full * per
            if full < runs and 0 < more < per:
                plan.place(w, 1, more, first + full, offset)
                put(space - more * w, first + full, 1)
                full += 1
            if full < runs:
                put(space, first + full, runs - full)


def make_plan(counts: dict[int, int], capacity: int) -> Plan:
    by = np.zeros(capacity + 1, np.int64)
    for w, n in counts.items():
        by[w] = n
    plan = Plan(by, capacity)
    reduce_instance(plan)
    best_fit(plan)
    return plan


def pack(pieced: DataFrame, capacity: int = 4096, id_col: str = "doc_id") -> DataFrame:
    """Add sequence_id and offset to a table of pieces; the table should be saved, it is read three times."""
    order = [F.col(id_col), F.col("piece"), F.col("ids_crc32")]
    salted = pieced.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)).cast("int"))
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))  # at most capacity x SALTS rows
    base = counts.withColumn("_base", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)))
    base = base.select("length", "_salt", F.coalesce("_base", F.lit(0)).alias("_base"))
    plan = make_plan({r["length"]: r["n"] for r in pieced.groupBy("length").agg(F.count("*").alias("n")).collect()}, capacity)  # at most `capacity` rows
    rows = sorted(plan.rows)
    places = np.array(rows, np.int64).reshape(-1, 6)
    start = np.searchsorted(places[:, 0], np.arange(capacity + 2))
    share = pieced.sparkSession.sparkContext.broadcast((places, start))  # rows: a few for each of `capacity` lengths
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*order)) - 1)
    ranked = ranked.join(F.broadcast(base), ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_salt", "_base")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, start = share.value
        key = places[:, 0] << 40 | places[:, 1]
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64)
            length, rank = get("length"), get("_rank")
            p = places[np.searchsorted(key, length << 40 | rank, side="right") - 1]
            within = rank - p[:, 1]
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n != "_rank"}
            cols["sequence_id"] = pa.array(p[:, 4] + within // p[:, 3], pa.int64())
            cols["offset"] = pa.array(p[:, 5] + within % p[:, 3] * length, pa.int64())
            yield pa.RecordBatch.from_arrays([*cols.values()], names=[*cols])

    kept = [*pieced.columns]
    fields = ", ".join(f"`{c}` {pieced.schema[c].dataType.simpleString()}" for c in kept)
    return ranked.select(*kept, "_rank").mapInArrow(deal, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize, cut and pack whole documents."""
    return pack(saved(pieces(docs, path, capacity, id_col=id_col, text_col=text_col), "pieces"), capacity, id_col)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids by the word_bpe_49k vocabulary."""
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
