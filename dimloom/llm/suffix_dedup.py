"""Removal of repeated substrings, exact, by suffix arrays over the stretches where repeats can be.

Every byte covered by a string of `length` bytes that also starts anywhere else in the corpus goes.

1. Anchors. In each window of `length` bytes the 100-byte piece of least hash is its anchor (one piece in about 150 is one). Equal
   windows have equal anchors, so a repeat can only be where an anchor comes back. Equal texts are one text from here on:
   all of a text that has copies is covered by its copies.
2. Regions. The windows that share one anchor are one stretch of at most 2 * length - 100 bytes, its region. First only 128-bit
   digests of regions are compared: a region that stands in several places repeats as a whole, and its bytes stay where they are.
   Of an anchor with several different regions each one goes, from one of its places, to the anchor's task; a task sorts the
   suffixes of the regions of several anchors by the two-stage method (``suffix_sort``), and adjacent common prefixes of
   `length` or more mark repeated windows. So near copies send little but the regions that their edits touch.
3. Anchors with more than `HOT` different regions (a line or passage that very many documents share) aren't sent to one task.
   Their windows are dealt by content: classes of `CLASS` neighbouring windows by a hash of the bytes all of them hold,
   classes that aren't alike in all texts by a hash of each window. This is exact up to equal 64-bit hashes (of n windows of hot
   anchors about n * n / 2**65 pairs are equal by chance).
4. Marks meet their texts again in one shuffle of the texts, and the rest of each text is kept.

Shuffled are digests of anchors' regions, one region for each digest of a repeated anchor, marks, and each text once; twice where the
places of step 2 are too many to broadcast by count. Defined results: null is empty; texts shorter than `length` lose nothing; repeated
rows are copies of one another; ids may be null or repeated; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _powers, mix64, partitions, saved, small, table, text_bytes
from .suffix_sort import repeated_starts

LENGTH = 400
PIECE = 100
HOT = 512
CLASS = 24
#: Bytes of regions that are sorted together.
BLOCK = 1 << 20
_PART = 1 << 20  # less than 2**20 positions, so that a position fits the low bits of a key


def _piece_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all stretches of `size` bytes."""
    power, back = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    n = len(data) - size + 1
    return mix64((total[size:] - total[:n]) * back[:n])


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours: running minima of blocks, forwards and backwards."""
    n = len(key) - width + 1
    full = np.full(-(-len(key) // width) * width, np.iinfo(np.uint64).max)
    full[: len(key)] = key
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(raw: bytes, length: int = LENGTH, piece: int = PIECE) -> tuple[np.ndarray, ...]:
    """(hash, position, first window, last window) of each anchor of a byte string; a long one is read in parts."""
    out = []
    for at in range(0, max(1, len(raw) - length + 1), _PART - length):
        data = np.frombuffer(raw, np.uint8)[at : at + _PART - 1]
        if len(data) < length:
            break
        h = _piece_hashes(data, piece)
        key = h & ~np.uint64(_PART - 1) | np.arange(len(h), dtype=np.uint64)
        least = _least(key, length - piece + 1)
        place = (least & np.uint64(_PART - 1)).astype(np.int64)
        start = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        p = place[start]
        out.append((h[p].view(np.int64), p + at, start + at, np.append(start[1:], len(place)) - 1 + at))
    if not out:
        e = np.empty(0, np.int64)
        return e, e, e, e
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, unit, n_bytes); unit, a hash of the text, and its length stand for the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("unit"), F.octet_length(text).cast("long").alias("n_bytes"))


_ANCHOR = "unit long, n_bytes long, anchor long, place long, start long, end long, d1 long, d2 long"


def _anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    """Each anchor of each text, where its region starts and ends, and the region's digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, rows, found, digests = set(), [], [], []
            for i, (t, u, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
                if (u, n) not in held:
                    held.add((u, n))
                    raw = text_bytes(t)
                    h, p, first, last = anchors(raw, length)
                    rows.append(np.full(len(h), i))
                    found.append((h, p, first, last + length))
                    digests += [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(first.tolist(), (last + length).tolist(), strict=True)]
            if rows:
                take = pa.array(np.concatenate(rows))
                d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                columns = [np.concatenate(c) for c in zip(*found, strict=True)] + [d[:, 0].copy(), d[:, 1].copy()]
                yield pa.RecordBatch.from_arrays([batch.column(1).take(take), batch.column(2).take(take), *map(pa.array, columns)], names=[f.split()[0] for f in _ANCHOR.split(", ")])

    return texts.filter(F.col("n_bytes") >= length).select("text", "unit", "n_bytes").mapInArrow(run, _ANCHOR)


_REGION = "anchor long, unit long, n_bytes long, first long, offset long, region binary, cores array<long>, alike array<long>, windows array<long>"


def _regions(wanted: DataFrame, length: int) -> DataFrame:
    """One row for each given anchor of each text (text, unit, n_bytes, places, hot places): its region, or hashes if it is hot.

    first: the region's first window; offset: bytes from it to the anchor. For hot anchors: hashes of its windows; and by class
    (of windows by their distance to the anchor) of the bytes common to them and of all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, unit, n, places, hot in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                raw = text_bytes(text)
                hashes, at, first, last = anchors(raw, length)
                here = np.isin(at, places)
                hot = set(hot or ())
                for h, p, a, b in zip(*(x[here].tolist() for x in (hashes, at, first, last)), strict=True):
                    part = raw[a : b + length]
                    if p in hot:
                        windows = _piece_hashes(np.frombuffer(part, np.uint8), length).view(np.int64)
                        cores, alike = [], []
                        for c in range((p - b) // CLASS, (p - a) // CLASS + 1):
                            low, high = p - c * CLASS - CLASS + 1, p - c * CLASS  # windows of the class, where they are
                            core = raw[high : low + length] + b"%d" % c
                            held = raw[max(low, a) : min(high, b) + length] + b"%d %d" % (max(low, a) - low, high - min(high, b))
                            cores.append(int.from_bytes(hashlib.blake2b(core, digest_size=8, key=b"%d" % h).digest(), "little", signed=True))
                            alike.append(int.from_bytes(hashlib.blake2b(held, digest_size=8).digest(), "little", signed=True))
                        out.append((h, unit, n, a, p - a, None, cores, alike, windows.tolist()))
                    else:
                        out.append((h, unit, n, a, p - a, part, None, None, None))
            if out:
                kinds = [pa.int64()] * 5 + [pa.binary()] + [pa.list_(pa.int64())] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[f.split()[0] for f in _REGION.split(", ")])

    return wanted.select("text", "unit", "n_bytes", "places", "hot").mapInArrow(run, _REGION)


def _sorted_marks(regions: DataFrame, length: int) -> DataFrame:
    """(unit, n_bytes, start, end) of repeated stretches, by sorting suffixes of all different regions of an anchor together."""
    rows = regions.filter("region is not null").select("anchor", "unit", "n_bytes", "first", "region")
    rows = rows.repartition(partitions(rows), "anchor").sortWithinPartitions("anchor")

    def block(held: list[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        out = []
        for (u, n, f, _), starts in zip(held, repeated_starts([h[3] for h in held], length), strict=True):
            if len(starts):
                cut = np.flatnonzero(np.diff(starts) > 1)
                out += [(u, n, f + a, f + b + length) for a, b in zip(starts[np.append(0, cut + 1)].tolist(), starts[np.append(cut, len(starts) - 1)].tolist(), strict=True)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["unit", "n_bytes", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, held, total = None, [], 0
        for batch in batches:
            for a, u, n, f, r in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                if a != anchor and total > BLOCK:
                    yield from block(held)
                    held, total = [], 0
                anchor = a
                held.append((u, n, f, r))
                total += len(r)
        yield from block(held)

    return rows.mapInArrow(run, "unit long, n_bytes long, start long, end long")


def _hot_marks(regions: DataFrame, length: int) -> DataFrame:
    """The same for hot anchors, by hashes of classes of windows and of windows."""
    hot = regions.filter("region is null")
    each = hot.select("unit", "n_bytes", "first", "offset", "windows", F.posexplode(F.arrays_zip("cores", "alike")).alias("i", "c"))
    # class number of a row: classes count from the window that starts at or next before the anchor
    last = F.size("windows") - 1
    c = F.floor((F.col("offset") - last) / CLASS) + F.col("i")
    low = F.greatest(F.lit(0), F.col("offset") - c * CLASS - CLASS + 1)
    high = F.least(last, F.col("offset") - c * CLASS)
    each = each.select("unit", "n_bytes", F.col("c.cores").alias("core"), F.col("c.alike").alias("alike"), (F.col("first") + low).alias("start"), F.slice("windows", (low + 1).cast("int"), (high - low + 1).cast("int")).alias("windows"))
    groups = each.groupBy("core").agg(F.count("*").alias("k"), F.min("alike").alias("lo"), F.max("alike").alias("hi")).filter("k > 1")
    met = saved(each.join(groups.select("core", (F.col("lo") == F.col("hi")).alias("all")), "core"), "hot-classes")
    whole = met.filter("all").select("unit", "n_bytes", "start", (F.col("start") + F.size("windows") - 1 + length).alias("end"))
    single = met.filter("not all").select("unit", "n_bytes", "start", F.posexplode("windows").alias("i", "w"))
    again = single.groupBy("w").agg(F.count("*").alias("k")).filter("k > 1").select("w")
    single = single.join(again, "w").select("unit", "n_bytes", (F.col("start") + F.col("i")).alias("start"), (F.col("start") + F.col("i") + length).alias("end"))
    return whole.union(single)


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_bytes, spans) of every row; spans: array of (start, end) whose bytes are covered, not yet merged, or null."""
    texts = _texts(docs, id_col, text_col)
    rows = saved(_anchor_rows(texts, length), "anchors")
    copies = texts.filter(F.col("n_bytes") >= length).groupBy("unit", "n_bytes").agg(F.count("*").alias("k")).filter("k > 1")
    place, region = F.xxhash64("unit", "n_bytes", "place"), ["anchor", "d1", "d2"]
    kinds = saved(rows.groupBy(*region).agg(F.min(place).alias("lo"), F.max(place).alias("hi")), "kinds-of-region")
    several = kinds.groupBy("anchor").agg(F.count("*").alias("k")).filter("k > 1")
    kinds = kinds.join(several, "anchor", "left").filter("lo != hi or k is not null")
    met = saved(rows.join(kinds, region).filter((F.col("lo") != F.col("hi")) | (place == F.col("lo"))), "repeated-anchors")
    whole = met.filter("lo != hi").select("unit", "n_bytes", "start", "end")
    asked = met.filter(F.col("k").isNotNull() & (place == F.col("lo"))).groupBy("unit", "n_bytes")
    asked = saved(asked.agg(F.collect_set("place").alias("places"), F.collect_set(F.when(F.col("k") > HOT, F.col("place"))).alias("hot")), "asked")
    once = texts.join(small(asked, 200_000), ["unit", "n_bytes"])
    regions = saved(_regions(once, length).dropDuplicates(["unit", "n_bytes", "first", "anchor"]), "regions")
    marks = whole.union(_sorted_marks(regions, length)).union(_hot_marks(regions, length)).union(copies.select("unit", "n_bytes", F.lit(0).cast("long"), "n_bytes"))
    spans = saved(marks.groupBy("unit", "n_bytes").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    # one plan at every size: the marks of a corpus outgrow a broadcast long before its texts
    return texts.join(spans.hint("merge"), ["unit", "n_bytes"], "left").select("id", "text", "n_bytes", "spans")


def merged(spans: list | None) -> list[tuple[int, int]]:
    """Maximal runs of spans that overlap or touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def kept_bytes(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    cuts = [0, *(x for r in runs for x in r), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept_text) of every row.

    kept_sha256 is of the remaining bytes; kept_text is their text, without parts of characters that a cut has left."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, count, sha, kept = [], [], [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw, runs = text_bytes(text), merged(spans)
                rest = kept_bytes(raw, runs)
                n.append(len(raw))
                gone.append(len(raw) - len(rest))
                count.append(len(runs))
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in (n, gone, count)), pa.array(sha, pa.string()), pa.array(kept, pa.string())], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    found = repeated_spans(docs, length, id_col, text_col).select("id", "text", "spans")
    return found.mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string").withColumnRenamed("id", id_col)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What 400-byte repeats leave of every document."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")
