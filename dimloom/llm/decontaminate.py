"""Benchmark decontamination: MinHash containment search, partitioned by size, verified by exact containment.

Texts are lower-cased words; shingles are five words. An item is found in a document if at least `threshold` of its distinct
shingles are among the document's.

A short item has a tiny Jaccard similarity to a long document, so domains are made of like size first: items fall in classes by
number of shingles (powers of two), and for each class every whole document is read as windows of twice the class's upper size,
half a window apart. A passage as long as any item of the class lies whole in some window, and its Jaccard similarity there
is at least threshold * q / (w + (1 - threshold) * q), over 0.19 (q of the item's, w of the window's shingles; items of 1 to 4
shingles have classes of their own for that).
`PERMUTATIONS` MinHash values of each window and item are compared one by one (bands of one row, the tuning for recall): at
that similarity the chance of no common value is below 0.001, for a class's largest items below 0.00001. Scattered shingles of
an item may reach the threshold over a whole document without such a window, so candidates by exact counts of shared shingles (or
by each item's rarest shingles, where the items are too many for a broadcast) are added: none is missed.
Candidates are verified over whole documents by the words themselves.

Defined results: items of fewer than five words have no shingle and are never found; null or empty texts hold nothing; repeated
documents are one result for each id (the highest containment); ids may be null; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mix64, saved, shingle_hashes, small, table, word_hashes

WORDS = 5
THRESHOLD = 0.8
PERMUTATIONS = 36
#: Item keys that are sent to every task; with more of them windows are joined by shuffles instead.
BROADCAST_KEYS = 1_000_000
_PIECE = 1 << 20
_SPACE = np.array([not (c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122) for c in range(256)])
_WORD = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")


def words(text: str | None) -> list[str]:
    """Lower-cased words: runs of ASCII letters and digits and of all other characters beyond ASCII."""
    return _WORD.findall((text or "").lower())


def _hashes(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").lower().encode("utf-8", "replace"), np.uint8)
    out = [word_hashes(data, _SPACE)[0]] if len(data) <= _PIECE else []
    if not out:  # long texts by pieces that end at a separator
        at = 0
        while at < len(data):
            end = min(at + _PIECE, len(data))
            while end < len(data) and not _SPACE[data[end]]:
                end += 1
            out.append(word_hashes(data[at:end], _SPACE)[0])
            at = end
    return np.concatenate(out)


def shingles(text: str | None) -> np.ndarray:
    h = _hashes(text)
    return shingle_hashes(h, WORDS) if len(h) >= WORDS else h[:0]


def size_class(n: int) -> int:
    """Items of 2**(c-1) < n <= 2**c shingles are in class c."""
    return int(n - 1).bit_length()


def _permuted(h: np.ndarray, j: int) -> np.ndarray:
    x = (h ^ np.uint64((0x9E3779B97F4A7C15 * (j + 1)) & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _seed(size: int, j: int) -> np.uint64:
    """Tells keys of different size classes and permutations apart."""
    return mix64(np.array([size * 1000 + j], np.uint64))[0]


def item_keys(text: str | None) -> np.ndarray:
    """The keys of an item: its least value of each permutation, with its size class."""
    h = shingles(text)
    if not len(h):
        return np.empty(0, np.int64)
    c = size_class(len(h))
    return np.array([_permuted(h, j).min() ^ _seed(c, j) for j in range(PERMUTATIONS)], np.uint64).view(np.int64)


def window_keys(texts: list[np.ndarray], classes: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of all windows of some texts' shingles, by size class and permutation, and the number of each window's text."""
    h = np.concatenate(texts)
    lengths = np.array([len(t) for t in texts])
    begin = np.cumsum(lengths) - lengths
    cuts = {}
    for c in classes:  # half windows of 2**c shingles; a window is one with the next of its text
        halves = -(-lengths // (1 << c))
        of = np.repeat(np.arange(len(texts)), halves)
        start = begin[of] + (np.arange(len(of)) - np.repeat(np.cumsum(halves) - halves, halves) << c)
        cuts[c] = (start, of, np.flatnonzero(of[:-1] == of[1:]))
    for j in range(PERMUTATIONS):
        g = _permuted(h, j)
        for c, (start, of, more) in cuts.items():
            least = np.minimum.reduceat(g, start)
            whole = least.copy()
            whole[more] = np.minimum(least[more], least[more + 1])
            yield (whole ^ _seed(c, j)).view(np.int64), of


def _exact_pairs(texts: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """(doc, item) of the documents that can reach the threshold, wherever an item's shingles stand in them.

    With items that can be broadcast, each document counts the shingles that it shares with each of them. With more, documents are joined
    to the rarest shingles of each item, `spare` of them: a document with none of these can't reach the threshold."""
    doc_kind, item_kind = texts.schema["doc"].dataType.simpleString(), items.schema["item"].dataType.simpleString()

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                h = np.unique(shingles(text))
                if len(h):
                    of = int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=8).digest(), "little", signed=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i] * len(h))), pa.array([of] * len(h)), pa.array([len(h)] * len(h), pa.int64()), pa.array(h.view(np.int64))], names=["item", "of", "size", "shingle"])

    held = saved(items.mapInArrow(of_items, f"item {item_kind}, of long, size long, shingle long").distinct(), "item-shingles")
    sets, share = held.select("of", "size", "shingle").distinct(), None
    if sets.count() <= BROADCAST_KEYS:
        got = sets.orderBy("shingle", "of").toArrow()
        known, start = np.unique(got.column("shingle").to_numpy(), return_index=True)
        ofs, at = np.unique(got.column("of").to_numpy(), return_inverse=True)
        size = np.zeros(len(ofs), np.int64)
        size[at] = got.column("size").to_numpy()
        share = texts.sparkSession.sparkContext.broadcast((known, np.append(start, len(at)), at, ofs, size))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, start, at, ofs, size = share.value
        for batch in batches if len(known) else ():
            row, found = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                h = shingles(text).view(np.int64)
                place = np.minimum(np.searchsorted(known, h), len(known) - 1)
                place = np.unique(place[known[place] == h])
                if len(place):
                    n, shared = np.unique(np.concatenate([at[start[p] : start[p + 1]] for p in place]), return_counts=True)
                    n = n[shared >= threshold * size[n] - 1e-9]
                    row += [i] * len(n)
                    found.append(ofs[n])
            if row:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(np.concatenate(found))], names=["doc", "of"])

    def of_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                h = np.unique(shingles(text))
                if len(h):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i] * len(h))), pa.array(h.view(np.int64))], names=["doc", "shingle"])

    if share is not None:
        found = texts.mapInArrow(counted, f"doc {doc_kind}, of long")
    else:
        hits = saved(texts.mapInArrow(of_docs, f"doc {doc_kind}, shingle long").join(sets.select("shingle").distinct(), "shingle"), "item-hits")
        often = hits.groupBy("shingle").agg(F.count("*").alias("n"))
        rank = F.row_number().over(Window.partitionBy("of").orderBy("n", "shingle"))
        ranked = sets.join(often, "shingle", "left").select("of", "size", "shingle", F.coalesce("n", F.lit(0)).alias("n")).withColumn("r", rank)
        spare = F.col("size") - F.ceil(F.col("size") * F.lit(threshold) - F.lit(1e-9)) + 1
        found = hits.join(ranked.filter((F.col("r") <= spare) & (F.col("n") > 0)).select("shingle", "of"), "shingle").select("doc", "of")
    return found.join(held.select("of", "item").distinct(), "of").select("doc", "item")


def found_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item id, n_item, n_shared, containment) of each item found in a document."""
    doc_kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    items = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("item_text"))

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                k = item_keys(text)
                if len(k):
                    c = size_class(len(shingles(text)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i] * len(k))), pa.array(k), pa.array([c] * len(k), pa.int32())], names=["item", "key", "class"])

    keys = saved(items.mapInArrow(of_items, f"item {item_kind}, key long, class int"), "item-keys")
    classes = sorted(r[0] for r in keys.select("class").distinct().collect())  # a few dozen at most
    n_keys = keys.count()
    only = None
    if n_keys <= BROADCAST_KEYS:
        only = docs.sparkSession.sparkContext.broadcast(np.unique(keys.select("key").toArrow().column("key").to_numpy()))

    def of_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = only.value if only is not None else None
        maybe = None
        if known is not None:  # a small table that rules most keys out
            maybe = np.zeros(1 << 22, bool)
            maybe[known & (1 << 22) - 1] = True

        def keys_of(rows: list[int], held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            keys, of = [], []
            for k, t in window_keys(held, classes):
                if maybe is not None:
                    at = np.flatnonzero(maybe[k & (1 << 22) - 1])
                    k, t = k[at], t[at]
                    at = np.minimum(np.searchsorted(known, k), len(known) - 1)
                    k, t = k[known[at] == k], t[known[at] == k]
                keys.append(k)
                of.append(t)
            got = np.unique(np.column_stack((np.array(rows)[np.concatenate(of)], np.concatenate(keys))), axis=0)
            return got[:, 0], got[:, 1]

        for batch in batches:
            rows, held, total = [], [], 0
            texts = batch.column(1).to_pylist() if classes else []
            for i, text in enumerate(texts):
                h = shingles(text)
                if len(h):
                    rows.append(i)
                    held.append(h)
                    total += len(h)
                if held and (total > 100_000 or i == len(texts) - 1):
                    row, k = keys_of(rows, held)
                    if len(k):
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(k)], names=["doc", "key"])
                    rows, held, total = [], [], 0

    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    hits = texts.mapInArrow(of_docs, f"doc {doc_kind}, key long")
    near = hits.join(keys.select("key", "item"), "key").select("doc", "item")
    pairs = saved(near.union(_exact_pairs(texts, items, threshold)).distinct(), "candidates")

    # Verification: each candidate document's text meets the texts of its items, not more than it has candidates for.
    asked = pairs.join(items, pairs["item"].eqNullSafe(items["item"])).select(pairs["doc"].alias("_doc"), pairs["item"], "item_text")
    asked = small(asked, 100_000)
    both = texts.join(asked, texts["doc"].eqNullSafe(asked["_doc"])).select("doc", "item", "text", "item_text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, grams = None, set()
        for batch in batches:
            rows, sizes, shared = [], [], []
            for i, (text, item) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                w = words(item)
                wanted = {tuple(w[j : j + WORDS]) for j in range(len(w) - WORDS + 1)}
                if text != last:
                    w = words(text)
                    last, grams = text, {tuple(w[j : j + WORDS]) for j in range(len(w) - WORDS + 1)}
                n = len(wanted & grams)
                if wanted and n >= threshold * len(wanted):
                    rows.append(i)
                    sizes.append(len(wanted))
                    shared.append(n)
            if rows:
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(sizes, pa.int64()), pa.array(shared, pa.int64())], names=["doc", "item", "n_item", "n_shared"])

    sure = both.mapInArrow(verify, f"doc {doc_kind}, item {item_kind}, n_item long, n_shared long")
    out = sure.groupBy("doc", "item").agg(F.max("n_item").alias("n_item"), F.max("n_shared").alias("n_shared"))
    return out.select(F.col("doc").alias(id_col), F.col("item").alias(item_id), "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in the documents."""
    return found_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
