"""Substring dedup by paragraphs: MinHash banding, exact verification, clusters.

Words are lower-cased runs of letters and digits, shingles are five words. Three kinds of paragraph are taken from a text:

* lines of at least `MIN_WORDS` words;
* long runs of `LONG` words over line breaks, which start where a shingle's hash is the least of all within `APART` places. Starts depend on
  the words around them and not on what stands before, so copies start alike wherever they are wrapped or embedded; two runs
  of a text stand too far apart to be alike themselves;
* short runs of `RUN` words over line breaks, which start at the least hash of each `GAP` places that follow each other. Every passage of
  RUN + GAP - 1 = 41 words or more that stands twice has one in common at least; of a longer one up to GAP - 1 words at each end may stay.

Paragraphs of equal words are one class from the start; short runs meet in no other way. Bands of `ROWS` MinHash values of lines and of long runs are
tuned for recall: at a Jaccard similarity of 0.8 a pair shares one of `BANDS` bands with probability 1 - (1 - 0.8**3)**8 > 0.996. Classes
that share a band are compared on whole shingle sets (``link_groups``; a band that only overlapping long runs of one text share is none), links are those of similarity 0.8 or more, and a component of links
is a cluster: its first paragraph (by document id, then place) stays, the others are removed.

``repeated_paragraphs`` gives the clusters of lines, ``repeated_passages`` the stretches of words that all kinds mark together. Words of a
paragraph that stays are never removed, and what overlaps the paragraph that stays, in its own text, stays as well: one whole copy of each cluster is left,
and a text that only repeats itself within a few words is left alone.

Defined results: null and empty texts have no paragraph; of ``repeated_paragraphs`` repeated rows repeat their paragraphs, paragraphs of rows
with a null id are only matched by equal words, and where no other row holds such a paragraph, the rows that hold it at its first place keep it. For
``repeated_passages`` a row is its id and its text, so rows of null id are compared like others (and come last when the one that stays is chosen),
and of rows that are equal in both the first (copy 0) is judged like any text, the others (copy 1 and up) lose all that repeats. Other columns
are not read. Only what stands in clusters of two or more is returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix64, run_hashes, saved, shingle_hashes, small, table, word_hashes
from .jaccard_join import as_lists, bounded, distances, least_distance, linked, sketch
from .linking import Metric, link_groups

MIN_WORDS = 30
RUN, GAP = 30, 12
LONG, APART = 60, 12
WORDS = 5
BANDS, ROWS = 8, 3
PERCENT = 80
_PIECE = 1 << 20
_SEPARATES = np.array([not (c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122) for c in range(256)])


def paragraph_shingles(text: str | None) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(place, words, unit, shingle hashes) of each paragraph of a text; unit stands for its sequence of words."""
    for i, line in enumerate((text or "").lower().split("\n")):
        if len(line) < 2 * MIN_WORDS - 1:
            continue
        words = word_hashes(np.frombuffer(line.encode("utf-8", "replace"), np.uint8), _SEPARATES)[0]
        if len(words) >= MIN_WORDS:
            unit = int.from_bytes(hashlib.blake2b(words.tobytes(), digest_size=8).digest(), "little", signed=True)
            yield i, len(words), unit, shingle_hashes(words, WORDS)


def band_keys(shingles: list[np.ndarray]) -> np.ndarray:
    """One row of band keys for each paragraph."""
    starts = np.cumsum([0, *map(len, shingles)])[:-1]
    h = np.concatenate(shingles)
    out = np.zeros((len(shingles), BANDS), np.uint64)
    for b in range(BANDS):
        for r in range(ROWS):
            seed = (0x9E3779B97F4A7C15 * (b * ROWS + r + 1)) & (1 << 64) - 1
            g = (h ^ np.uint64(seed)) * np.uint64(0xD6E8FEB86659FD93)
            out[:, b] = mix64(out[:, b] + np.minimum.reduceat(g ^ (g >> np.uint64(32)), starts))
        out[:, b] += np.uint64(b)
    return mix64(out.ravel()).view(np.int64).reshape(out.shape)


def words_and_lines(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and line number of each word of a whole text."""
    data = np.frombuffer((text or "").lower().encode("utf-8", "replace"), np.uint8)
    breaks = np.flatnonzero(data == 10)
    hashes, places, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while at < len(data):
        end = min(at + _PIECE, len(data))
        while end < len(data) and not _SEPARATES[data[end]]:
            end += 1
        h, first, _ = word_hashes(data[at:end], _SEPARATES)
        hashes.append(h)
        places.append(first + at)
        at = end
    return np.concatenate(hashes), np.searchsorted(breaks, np.concatenate(places))


def short_starts(s: np.ndarray, n: int) -> np.ndarray:
    """First words of the short runs of a text of n words with shingles s: the least shingle of each `GAP` starts in a row, the first and the last start."""
    m = n - RUN + 1
    if m < 1:
        return np.empty(0, np.int64)
    if m <= GAP:
        return np.unique([0, int(s[:m].argmin()), m - 1])
    least = np.lib.stride_tricks.sliding_window_view(s[:m], GAP).argmin(axis=1) + np.arange(m - GAP + 1)
    return np.unique(np.concatenate(([0, m - 1], least)))


def long_starts(s: np.ndarray, n: int) -> np.ndarray:
    """First words of the long runs: shingles less than all others within `APART` places."""
    m = n - LONG + 1
    if m < 1:
        return np.empty(0, np.int64)
    padded = np.concatenate((np.full(APART, ~np.uint64(0)), s, np.full(APART, ~np.uint64(0))))
    around = np.lib.stride_tricks.sliding_window_view(padded, 2 * APART + 1)[:m]
    return np.flatnonzero(around.argmin(axis=1) == APART)


def near_units(words: np.ndarray, lines: np.ndarray, s: np.ndarray) -> Iterator[tuple[int, int, int, bool]]:
    """(first word, words, unit, is a long run) of the paragraphs of a text that are banded."""
    first = np.flatnonzero(np.diff(lines, prepend=-1))
    for at, n in zip(first.tolist(), np.diff(np.append(first, len(words))).tolist(), strict=True):
        if n >= MIN_WORDS:
            yield at, n, int.from_bytes(hashlib.blake2b(words[at : at + n].tobytes(), digest_size=8).digest(), "little", signed=True), False
    starts = long_starts(s, len(words))
    for at, unit in zip(starts.tolist(), run_hashes(words, starts, LONG).view(np.int64).tolist(), strict=True):
        yield at, LONG, unit, True


def _passages(rows: DataFrame) -> DataFrame:
    """(id, h, place, n, unit, bands) of every paragraph of rows (id, h, text); no bands for short runs."""
    kind = rows.schema["id"].dataType.simpleString()

    def give(batch: pa.RecordBatch, row, place, n, unit, bands: np.ndarray | None) -> pa.RecordBatch:
        head = [batch.column(i).take(pa.array(row, pa.int64())) for i in (0, 1)]
        none = pa.nulls(len(row), pa.list_(pa.int64())) if bands is None else pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS), pa.int32()), pa.array(bands.ravel()))
        return pa.RecordBatch.from_arrays([*head, pa.array(place, pa.int32()), pa.array(n, pa.int32()), pa.array(unit, pa.int64()), none], names=["id", "h", "place", "n", "unit", "bands"])

    def short(batch: pa.RecordBatch, parts: list[tuple]) -> pa.RecordBatch:
        row, place, unit = (np.concatenate(x) for x in zip(*parts, strict=True))
        return give(batch, row, place, np.full(len(row), RUN), unit.view(np.int64), None)

    def banded(batch: pa.RecordBatch, near: list[tuple], shingles: list[np.ndarray]) -> pa.RecordBatch:
        row, place, n, unit, long = zip(*near, strict=True)
        # lines meet lines (even keys) and long runs long runs (odd ones)
        return give(batch, row, place, n, unit, (band_keys(shingles) & ~np.int64(1)) | np.array(long, np.int64)[:, None])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, near, shingles, total = [], [], [], 0
            for row in range(batch.num_rows):
                words, lines = words_and_lines(batch.column(2)[row].as_py())
                if len(words) < MIN_WORDS:
                    continue
                s = shingle_hashes(words, WORDS)
                starts = short_starts(s, len(words))
                parts.append((np.full(len(starts), row), starts, run_hashes(words, starts, RUN)))
                for at, n, unit, long in near_units(words, lines, s):
                    near.append((row, at, n, unit, long))
                    shingles.append(s[at : at + n - WORDS + 1])
                    if len(near) == 4000:
                        yield banded(batch, near, shingles)
                        near, shingles = [], []
                total += len(words)
                if total > 100_000:
                    yield short(batch, parts)
                    parts, total = [], 0
            if parts:
                yield short(batch, parts)
            if near:
                yield banded(batch, near, shingles)

    return rows.select("id", "h", "text").mapInArrow(run, f"id {kind}, h long, place int, n int, unit long, bands array<long>")


def _paragraphs(rows: DataFrame) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, *p) for i, t in enumerate(batch.column(1).to_pylist()) for p in paragraph_shingles(t)]
            for at in range(0, len(found), 2000):
                row, place, n, unit, s = zip(*found[at : at + 2000], strict=True)
                keys = band_keys(list(s))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(place, pa.int32()), pa.array(n, pa.int32()), pa.array(unit, pa.int64()), bands], names=["id", "paragraph", "n_words", "unit", "bands"])

    return rows.mapInArrow(run, f"id {kind}, paragraph int, n_words int, unit long, bands array<long>")


def _sets(rows: DataFrame) -> DataFrame:
    """(node, members) of the wanted paragraphs of rows (text, wanted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                wanted = set(wanted)
                for _, _, unit, s in paragraph_shingles(text):
                    if unit in wanted:
                        wanted.discard(unit)
                        nodes.append(unit)
                        sets.append(np.unique(s))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), as_lists(sets)], names=["node", "members"])

    return rows.select("text", "wanted").mapInArrow(run, "node long, members array<long>")


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, paragraph, n_words, first id, first paragraph, removed) of each paragraph that is in a cluster."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = saved(_paragraphs(rows), "paragraphs")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "paragraph")  # rows without an id last
    units = found.groupBy("unit").agg(F.count("*").alias("k"), F.min(place).alias("first"))
    bands = found.select("unit", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.min("unit").alias("lo"), F.max("unit").alias("hi")).filter("lo != hi").select("key")
    members = saved(bands.join(shared, "key").select("key", F.col("unit").alias("node")).distinct(), "members")
    wanted = units.join(members.select(F.col("node").alias("unit")).distinct(), "unit").filter("not first.none")
    by_doc = saved(wanted.groupBy(F.col("first.id").alias("_at")).agg(F.collect_list("unit").alias("wanted")), "wanted")
    sets = saved(_sets(rows.join(small(by_doc, 200_000), F.col("id") == F.col("_at"))).dropDuplicates(["node"]), "paragraph-sets")
    metric = Metric(lambda p: distances(p, sets), lambda p: p.withColumn("least", F.lit(0.0)), 1 - percent / 100)
    comp, _ = link_groups(members, lambda pairs: linked(pairs, sets, percent), metric=metric)
    at = units.join(comp, F.col("unit") == F.col("node"), "left").select("unit", "k", "first", F.coalesce("component", "unit").alias("component"))
    clusters = at.groupBy("component").agg(F.sum("k").alias("k"), F.min("first").alias("kept")).filter("k > 1")
    named = at.select("unit", "component").join(clusters.select("component", "kept"), "component").select("unit", "kept")
    out = found.select("id", "paragraph", "n_words", "unit").join(named, "unit")
    stays = F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("paragraph") == F.col("kept.paragraph"))
    return out.select(F.col("id").alias(id_col), "paragraph", "n_words", F.col("kept.id").alias(f"first_{id_col}"), F.col("kept.paragraph").alias("first_paragraph"), (~stays).alias("removed"))


def _passage_sets(rows: DataFrame) -> DataFrame:
    """(node, n, bits, members) of the wanted banded paragraphs of rows (text, wanted): size, sketch and whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            for text, wanted in zip(batch.column(0), batch.column(1), strict=True):
                words, lines = words_and_lines(text.as_py())
                s, wanted = shingle_hashes(words, WORDS), set(wanted.as_py())
                for at, n, unit, _ in near_units(words, lines, s):
                    if unit in wanted:
                        wanted.discard(unit)
                        nodes.append(unit)
                        sets.append(np.unique(s[at : at + n - WORDS + 1]))
            sizes, bits = pa.array([len(x) for x in sets], pa.int64()), pa.array([sketch(x) for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), sizes, bits, as_lists(sets)], names=["node", "n", "bits", "members"])

    return rows.select("text", "wanted").mapInArrow(run, "node long, n long, bits binary, members array<long>")


def _near_classes(rows: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """(unit, component) of the banded units that link with another one."""
    # a long run's text (40 bits) and place: runs that overlap in one text look alike but are no copies, and a key of such runs only is none
    spot = F.col("h").bitwiseAND(F.lit(~0xFFFFFF)).bitwiseOR(F.least("place", F.lit(0xFFFFFF)).cast("long"))
    bands = found.filter("bands is not null").select("unit", spot.alias("spot"), F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("unit", "spot") for f in (F.min, F.max)])
    apart = F.expr("key & 1 = 0 or shiftright(min_spot, 24) != shiftright(max_spot, 24)") | (F.col("max_spot") - F.col("min_spot") >= LONG) | (F.col("max_spot").bitwiseAND(F.lit(0xFFFFFF)) == 0xFFFFFF)
    shared = saved(shared.filter("min_unit != max_unit").filter(apart).select("key"), "shared-bands")
    members = saved(bands.join(small(shared), "key").select("key", F.col("unit").alias("node")).distinct(), "members")
    asked = small(saved(members.select(F.col("node").alias("unit")).distinct(), "asked"))
    first = found.filter("bands is not null").select("unit", "id", "h").join(asked, "unit").groupBy("unit").agg(F.min(F.struct("h", "id")).alias("at"))
    by_row = saved(first.groupBy(F.col("at.h").alias("_h"), F.col("at.id").alias("_id")).agg(F.collect_list("unit").alias("wanted")), "wanted")
    texts = rows.join(small(by_row, 200_000), (F.col("h") == F.col("_h")) & F.col("id").eqNullSafe(F.col("_id")))
    made = saved(_passage_sets(texts).dropDuplicates(["node"]), "paragraph-sets")
    sets, sketches = made.select("node", "members"), made.select("node", "n", "bits")
    # sketches are a quarter of the sets and leave few pairs that don't link
    metric = Metric(lambda p: distances(p, sets), lambda p: least_distance(p, sketches), 1 - percent / 100)
    comp, _ = link_groups(members, lambda pairs: linked(bounded(pairs, sketches, percent), sets, percent), metric=metric)
    several = comp.groupBy("component").count().filter("count > 1").select("component")
    return comp.join(several, "component").select(F.col("node").alias("unit"), "component")


def stretches(paragraphs: list[dict]) -> tuple[list[tuple], list[tuple]]:
    """The marked stretches (first word, words, id of the copy that stays, removed) of a text, and those of a further equal row.

    paragraphs: place, n, component, first (id), own (whether the one that stays is of this text) and kept (its place)."""
    paragraphs = sorted(paragraphs, key=lambda p: (p["place"], -p["n"]))
    end = max(p["place"] + p["n"] for p in paragraphs)
    gone, stays, every, reach = np.zeros(end, bool), np.zeros(end, bool), np.zeros(end, bool), {}
    for p in paragraphs:
        at, to, c = p["place"], p["place"] + p["n"], p["component"]
        held = p["own"] and (at == p["kept"] or at < reach.get(c, 0))
        if held:
            reach[c] = max(to, reach.get(c, 0))
        (stays if held else gone)[at:to] = True
        every[at:to] = True
    gone &= ~stays
    places = np.array([p["place"] for p in paragraphs])
    ends = places + np.array([p["n"] for p in paragraphs])

    def cut(mask: np.ndarray, removed: bool) -> list[tuple]:
        edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).view(np.int8)))
        return [(a, b - a, paragraphs[int(np.argmax((places < b) & (ends > a)))]["first"], removed) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]

    return cut(stays, False) + cut(gone, True), cut(every, True)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, copy, first word, n_words, first id, removed) of each stretch of words that is marked by paragraphs in clusters."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = saved(_passages(rows), "passages")
    near = saved(_near_classes(rows, found, percent), "near-classes")
    twice = found.groupBy("unit").count().filter("count > 1").select("unit")
    named = saved(twice.join(near, "unit", "full").select("unit", F.coalesce("component", "unit").alias("component")), "classes")
    marks = saved(found.select("id", "h", "place", "n", "unit").join(small(named), "unit").drop("unit"), "marks")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "h", "place")  # rows without an id last
    kept = marks.groupBy("component").agg(F.min(place).alias("kept"), F.count("*").alias("k")).filter("k > 1").select("component", "kept")
    own = (F.col("h") == F.col("kept.h")) & F.col("id").eqNullSafe(F.col("kept.id"))
    one = F.struct("place", "n", "component", F.col("kept.id").alias("first"), own.alias("own"), F.col("kept.place").alias("kept"))
    of_row = marks.join(small(saved(kept, "kept")), "component").groupBy("id", "h").agg(F.collect_set(one).alias("paragraphs"))
    equal = small(saved(rows.groupBy("id", "h").count().filter("count > 1").select(F.col("id").alias("_id"), F.col("h").alias("_h"), F.col("count").alias("rows")), "equal-rows"))
    of_row = of_row.join(equal, (F.col("h") == F.col("_h")) & F.col("id").eqNullSafe(F.col("_id")), "left").select("id", "paragraphs", F.coalesce("rows", F.lit(1)).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one, more = stretches(batch.column(1)[row].as_py())
                for copy in range(batch.column(2)[row].as_py()):
                    got = more if copy else one
                    if got:
                        first, n, of, removed = zip(*got, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array([row] * len(got))), pa.array([copy] * len(got), pa.int64()), pa.array(first, pa.int32()), pa.array(n, pa.int32()), pa.array(of, batch.schema.field(0).type), pa.array(removed)],
                            names=["id", "copy", "first_word", "n_words", "first", "removed"],
                        )

    out = of_row.mapInArrow(run, f"id {kind}, copy long, first_word int, n_words int, first {kind}, removed boolean")
    return out.select(F.col("id").alias(id_col), "copy", "first_word", "n_words", F.col("first").alias(f"first_{id_col}"), "removed")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of words that repeat across the documents, nearly or exactly."""
    return repeated_passages(table(spark, sf_dir, "documents"))
