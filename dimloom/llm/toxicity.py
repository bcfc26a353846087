"""Toxicity of a text by two class-conditional Kneser-Ney models of its words.

Each class, toxic and ordinary, gives a word the probability

    P_c(w) = max(n_c(w) - D_c, 0) / N_c  +  (share of N_c that the discounts free) * S(w),

where S is one backoff model that both classes share. All counts are Kneser-Ney's kind, of contexts and not of occurrences: n_c(w) is
the number of documents of the class in which w stands (so one text that repeats a line counts once), N_c their sum over
all words, and S(w) the share of both classes' counts that is w's. The discounts are in proportion to the classes' sizes; of those
in `DISCOUNTS` the one is taken with which the regression fits its own labelled fold best, so rare words keep what
evidence the labels support and the shared backoff smooths the rest. A text's two log-likelihoods (of its distinct words) are
compared per word and per square root of words, beside the strongest word and the strong evidence (a few words of a long text
would drown in the sums alone); a logistic regression on these, fitted on rows that the counts were not taken from, turns them into a score.

Counts come from every labelled row that may be learned from, but for one fold kept for the regression, which uses a sample of
about `CALIBRATION_ROWS` of its rows (a documented bound). Counting is a shuffle of distinct words, pre-aggregated in each batch
and task, and grows with the labelled text. Words above a discount have a log-ratio of their own, all others one common log-ratio.
The `BROADCAST_WORDS` words of most documents are broadcast with their 64-bit hashes; the others are joined to the documents' words.

Defined results: null, empty and word-free texts have no evidence and get the regression's score for none; without
labelled rows of both classes every score is 0. Repeated rows get equal scores; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import parts_of, saved, slices, small, table, word_hashes
from .language_id import clean_bytes

#: Discounts of the smaller class, in documents, from which the labelled fold of the regression chooses; the other's is larger by the ratio of their sizes.
DISCOUNTS = (0.75, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 10.0, 15.0)
#: A log-ratio beyond this is strong evidence.
STRONG = 1.0
#: Words that are sent to every task; with more of them the others are joined by a shuffle.
BROADCAST_WORDS = 1_000_000
CALIBRATION_ROWS = 20_000
_SPACE = np.isin(np.arange(256), (0, 32))


def words_of(texts: list[str], of: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct words of each text, and the number of that text; of: the numbers of texts that come in parts."""
    arrays = [clean_bytes(t) for t in texts]
    ends = np.cumsum([len(a) for a in arrays])
    h, first, _ = word_hashes(np.concatenate(arrays), _SPACE)
    at = np.searchsorted(ends, first, side="right")
    at = at if of is None else np.array(of, np.int64)[at]
    order = np.lexsort((at, h))
    h, at = h[order], at[order]
    other = np.concatenate(([True], (h[1:] != h[:-1]) | (at[1:] != at[:-1]))) if len(h) else np.empty(0, bool)
    return h[other], at[other]


def count_words(rows: DataFrame) -> DataFrame:
    """(word, toxic, ordinary): the documents of each class with the word; rows: (text, toxic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch, "text"):
                part = batch.slice(lo, hi - lo)
                h, of = words_of([t or "" for t in part.column(0).to_pylist()])
                if not len(h):
                    continue
                toxic = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)[of]
                start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
                n, t = np.diff(np.append(start, len(h))), np.add.reduceat(toxic, start)
                yield pa.RecordBatch.from_arrays([pa.array(h[start].view(np.int64)), pa.array(t), pa.array(n - t)], names=["word", "t", "o"])

    counted = rows.select("text", "toxic").mapInArrow(run, "word long, t long, o long")
    return counted.groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


class Model:
    """Sizes of the classes, the discounts that are still considered, words with evidence and the regression's weights.

    `hot` has the hashes of the words that are sent to every task, `ratio` their log-ratios, a row for each discount; `rest` is a
    table (word, t, o) of all other words with evidence, or none. Any other word has the ratio `common`."""

    def __init__(self, counts: DataFrame, discounts: tuple[float, ...] = DISCOUNTS):
        self.counts, self.weights, self.rest = counts, np.zeros(5), None
        n = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in "to"]).first()
        self.known = n["t"] > 0 and n["o"] > 0
        self.size = {c: float(n[c]) for c in "to"}
        if self.known:
            self.consider(discounts)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("counts", "rest")}

    def consider(self, discounts: tuple[float, ...]) -> None:
        """Take the ratios of these discounts."""
        least = min(self.size.values())
        self.discounts = discounts
        self.cut = {c: [x * self.size[c] / least for x in discounts] for c in "to"}
        freed = self.counts.agg(*[F.sum(F.least(c, F.lit(x))).alias(f"{c}{k}") for c in "to" for k, x in enumerate(self.cut[c])]).first()
        self.freed = {c: [freed[f"{c}{k}"] / self.size[c] for k in range(len(discounts))] for c in "to"}
        self.common = np.array([math.log(t / o) for t, o in zip(self.freed["t"], self.freed["o"], strict=True)])
        judged = self.counts.filter((F.col("t") > min(self.cut["t"])) | (F.col("o") > min(self.cut["o"])))
        times = F.least(F.col("t") + F.col("o"), F.lit(1000))
        found, above = 0, 1001  # words in at least `above` documents are sent to every task
        for r in judged.groupBy(times.alias("c")).count().orderBy(F.desc("c")).collect():  # 1000 rows at most
            if found + r["count"] > BROADCAST_WORDS:
                break
            found, above = found + r["count"], r["c"]
        else:
            above = 0
        got = judged.filter(times >= above).select("word", *[self.ratio_of(k).alias(f"r{k}") for k in range(len(discounts))]).toArrow()
        hot = got.column("word").to_numpy().view(np.uint64)
        order = np.argsort(hot)
        self.hot = hot[order]
        self.ratio = np.array([got.column(f"r{k}").to_numpy()[order] for k in range(len(discounts))], np.float32)
        self.rest = saved(judged.filter(times < above), "rest") if above else None

    def ratio_of(self, k: int) -> Column:
        """The log-ratio of a row (t, o)."""
        shared = (F.col("t") + F.col("o")) / F.lit(sum(self.size.values()))
        p = lambda c: F.greatest(F.col(c) - F.lit(self.cut[c][k]), F.lit(0.0)) / F.lit(self.size[c]) + F.lit(self.freed[c][k]) * shared
        return F.log(p("t")) - F.log(p("o"))

    def evidence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Of whole texts: the words, how many of them aren't hot, what hot ones add (sum, largest, strong by discount), and the others of each."""
        cut = [(i, p) for i, t in enumerate(texts) for p in parts_of(t)]
        h, of = words_of([p for _, p in cut], [i for i, _ in cut])
        at = np.minimum(np.searchsorted(self.hot, h), max(0, len(self.hot) - 1))
        is_hot = self.hot[at] == h if len(self.hot) else np.zeros(len(h), bool)
        got = np.zeros((len(self.common), 3, len(texts)))
        got[:, 1] = -np.inf
        for k, ratio in enumerate(self.ratio):
            r, to = ratio[at[is_hot]].astype(float), of[is_hot]
            got[k, 0] = np.bincount(to, r, len(texts))
            np.maximum.at(got[k, 1], to, r)
            got[k, 2] = np.bincount(to, np.maximum(r - STRONG, 0), len(texts))
        n, other = np.bincount(of, minlength=len(texts)), np.bincount(of[~is_hot], minlength=len(texts))
        left = h[~is_hot][np.argsort(of[~is_hot], kind="stable")]
        return n, other, got, np.split(left, np.cumsum(other)[:-1]) if len(texts) else []

    def score(self, x: Column) -> Column:
        """Of an array of inputs."""
        z = sum((x[i] * F.lit(float(w)) for i, w in enumerate(self.weights)), F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def inputs(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns of `keep` and, for each discount k, an array x{k} of the regression's inputs for the whole text.

    They are the evidence per word and per square root of words, that of the strongest word, that beyond `STRONG` per square root of
    words, and 1. Words that are too many for a broadcast are joined to the counted ones by their whole hashes."""
    share = rows.sparkSession.sparkContext.broadcast(model)  # BROADCAST_WORDS words at most
    of = range(len(model.common))
    names = [f"{c}{k}" for k in of for c in "sml"]
    asked = model.rest is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, row = share.value, 0
        for batch in batches:
            for lo, hi in slices(batch, "_text", 1 << 20):
                part = batch.slice(lo, hi - lo)
                texts = [t or "" for t in part.column(0).to_pylist()]
                n, other, got, words = model.evidence(texts)
                columns = [*part.columns[1:], pa.array(n), pa.array(other), *[pa.array(got[k, j]) for k in of for j in range(3)]]
                if asked:
                    columns += [pa.array([hashlib.blake2b(t.encode("utf-8", "replace"), digest_size=16).digest() for t in texts], pa.binary()), pa.array(np.arange(row, row + len(texts)))]
                    columns.append(pa.array([w.view(np.int64) for w in words], pa.list_(pa.int64())))
                    row += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[1:], "_n", "_other", *names, *["_text_key", "_row", "_words"] * asked])

    kinds = ", ".join([*[f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep], "_n long, _other long", *[f"{c} double" for c in names], *["_text_key binary, _row long, _words array<long>"] * asked])
    out = rows.select(F.col("text").alias("_text"), *keep).mapInArrow(run, kinds)
    if asked:  # equal texts have equal sums: one row of each is enough
        pairs = out.select("_text_key", F.spark_partition_id().alias("_part"), "_row", F.explode("_words").alias("word"))
        met = pairs.join(model.rest, "word").select("_text_key", "_part", "_row", *[model.ratio_of(k).alias(f"r{k}") for k in of])
        aggregates = [a for k in of for a in (F.sum(f"r{k}").alias(f"_s{k}"), F.max(f"r{k}").alias(f"_m{k}"), F.sum(F.greatest(F.col(f"r{k}") - F.lit(STRONG), F.lit(0.0))).alias(f"_l{k}"))]
        met = met.groupBy("_text_key", "_part", "_row").agg(F.count("*").alias("_met"), *aggregates).dropDuplicates(["_text_key"]).drop("_part", "_row")
        out = out.drop("_words").join(met, "_text_key", "left")
        more = lambda c: F.coalesce(F.col(f"_{c}"), F.lit(0.0))
        out = out.withColumns({f"{c}{k}": F.greatest(f"m{k}", f"_m{k}") if c == "m" else F.col(f"{c}{k}") + more(f"{c}{k}") for k in of for c in "sml"})
        out = out.withColumn("_other", F.col("_other") - F.coalesce("_met", F.lit(0)))
    n, other = F.greatest(F.col("_n"), F.lit(1)).cast("double"), F.col("_other")

    def of_one(k: int) -> Column:
        common = float(model.common[k])
        total = F.col(f"s{k}") + other * F.lit(common)
        most = F.when((other > 0) | (F.col("_n") == 0), F.greatest(F.col(f"m{k}"), F.lit(common))).otherwise(F.col(f"m{k}"))
        strong = F.col(f"l{k}") + other * F.lit(max(common - STRONG, 0.0))
        return F.array(total / n, total / F.sqrt(n), most, strong / F.sqrt(n), F.lit(1.0)).alias(f"x{k}")

    return out.select(*[F.col(f"`{c}`") for c in keep], *[of_one(k) for k in of])


def scored(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """score beside the columns of `keep`."""
    if not model.known:
        return rows.select(*keep, F.lit(0.0).alias("score"))
    return inputs(rows, model, keep).select(*[F.col(f"`{c}`") for c in keep], model.score(F.col("x0")).alias("score"))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on labelled rows whose crc32(id as text) mod 5 is not 0: folds 1 to 3 are counted, fold 4 is for the regression and the discount."""
    fold = F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5))
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold != 0))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    fold = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    model = Model(saved(count_words(rows.join(small(known.filter(fold != 4), 2_000_000), "id")), "words"))
    if model.known:
        rest = known.filter(fold == 4)
        n = max(1, rest.count())
        drawn = rest.filter(F.pmod(F.xxhash64(F.lit("toxic"), "id"), F.lit(1 << 20)) < int(min(1, CALIBRATION_ROWS / n) * (1 << 20)))
        got = inputs(rows.join(small(drawn), "id"), model, ["toxic"]).toArrow()
        y = got.column("toxic").to_numpy().astype(float)
        best, chosen, model.weights = -math.inf, DISCOUNTS[0], np.array([0.0, 1.0, 0.0, 0.0, 0.0])
        for k, discount in enumerate(DISCOUNTS if 0 < y.sum() < len(y) else ()):
            x = np.array(got.column(f"x{k}").to_pylist())
            order = np.lexsort((y, x[:, 2], x[:, 1], x[:, 0]))
            w = fit(x[order], y[order])
            fits = -np.logaddexp(0, (x @ w) * (1 - 2 * y)).sum()  # log-likelihood of the fold
            if fits > best:
                best, chosen, model.weights = fits, discount, w
        model.consider((chosen,))
    return model


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; a fifth of the documents is never learned from."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    out = scored(docs, model, ["doc_id"])
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
