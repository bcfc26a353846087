"""Language of a text: averaged hashed subword embeddings and a linear softmax, with calibrated rejection.

Features are the 2- to 4-byte pieces of lower-cased words with their edges, hashed to `BUCKETS` rows of an embedding table;
a text is the mean of its pieces' embeddings. The table and the softmax weights are learned together by stochastic
gradient descent in numpy, on a sample of about `PER_LANG` labelled rows for each language (a documented bound; every row
has the same chance) and on short stretches of them, so that short texts are told apart too. A part of the sample is kept
from the descent: on it a temperature is fitted, so that scores are probabilities, and the rejection bound is set to the
score that all but `REJECTED` of those texts reach (0.5 at most).

As the model is linear, the learned tables multiply to one small table (bucket x language), and prediction is the mean of
its rows over a whole text, whatever its length.

Defined results: a null text, or one without a letter, is `und` with score 0 and is rejected; so is every text if there
is no labelled row to learn from. Repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import parts_of, slices, table

BUCKETS = 1 << 16
DIMENSIONS = 16
#: Labelled rows of each language that are learned from, about.
PER_LANG = 800
#: Share of held texts below the rejection bound.
REJECTED = 0.001
EPOCHS = 6
_LETTER = regex.compile(r"\p{L}")
#: ASCII letters and every byte of a longer character stay; other bytes part words.
_KEEP = bytes(c if c >= 0x80 or 97 <= c <= 122 else 32 for c in range(256))


def clean_bytes(text: str) -> np.ndarray:
    """Lower-cased letters with single spaces between and around words, one byte 0 at the end."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_KEEP) + b" \0", np.uint8)
    space = data == 32
    return data[~(space & np.concatenate(([False], space[:-1])))]


def piece_buckets(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each piece length: the buckets of the pieces that start at each byte, and which of them count."""
    n = len(data)
    wide = data.astype(np.uint32)
    end, inner = data == 0, data == 32
    h = wide * np.uint32(0x9E3779B1)
    bad = end.copy()
    for size in (2, 3, 4):
        m = n - size + 1
        if m <= 0:
            return
        h = (h[:m] ^ (h[:m] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + wide[size - 1 :]
        bad = bad[:m] | end[size - 1 :]
        if size > 2:
            bad |= inner[size - 2 : n - 1]  # a space inside
        yield ((h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(16)).astype(np.int64) & (BUCKETS - 1), ~bad


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their weights, which add up to 1."""
    found = [b[ok] for b, ok in piece_buckets(clean_bytes(text))]
    b, n = np.unique(np.concatenate(found) if found else np.empty(0, np.int64), return_counts=True)
    return b.astype("<u2"), (n / max(1, n.sum())).astype("<f4")


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def probabilities(self, mean: np.ndarray) -> np.ndarray:
        z = (mean + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)


def train(samples: list[tuple[int, np.ndarray, np.ndarray]], held: list[tuple[int, np.ndarray, np.ndarray]], langs: list[str]) -> Model:
    """samples, held: (language number, buckets, weights)."""
    rng = np.random.default_rng(7)
    table_ = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 0.1, (DIMENSIONS, len(langs))).astype(np.float32)
    bias = np.zeros(len(langs), np.float32)
    counts = np.bincount([s[0] for s in samples], minlength=len(langs))
    balance = len(samples) / np.maximum(1, counts) / len(langs)
    steps, step = EPOCHS * len(samples), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(samples)):
            y, b, w = samples[i]
            if not len(b):
                continue
            rate = 0.5 * (1 - step / steps) * min(4.0, balance[y])
            step += 1
            v = w @ table_[b]
            z = v @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = weights @ p
            weights -= rate * np.outer(v, p)
            bias -= rate * 0.1 * p
            # a text's pieces share its gradient; scaling by their weight alone would hardly move long texts' pieces
            table_[b] -= (rate * w / np.sqrt((w * w).sum()))[:, None] * back
    model = Model(langs, (table_ @ weights).astype(np.float32), bias)
    rows = held or samples
    mean = np.array([w @ model.scores[b] for _, b, w in rows], np.float64).reshape(-1, len(langs))
    truth = np.array([y for y, _, _ in rows])

    def loss(t: float) -> float:
        model.temperature = t
        return float(-np.log(np.maximum(1e-9, model.probabilities(mean)[np.arange(len(rows)), truth])).mean())

    model.temperature = min(np.geomspace(0.05, 10, 40), key=loss)
    model.reject_below = min(0.5, float(np.quantile(model.probabilities(mean).max(axis=1), REJECTED)))
    return model


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG) -> Model:
    """Fit on rows whose crc32(id as text) mod 5 is not 0 and whose language is given."""
    fold = F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5))
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & (fold != 0))
    counts = {r[0]: r[1] for r in labelled.groupBy(lang_col).count().collect()}  # one row a language
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    chance = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, per_lang / counts[k])))])
    drawn = labelled.filter(F.pmod(F.xxhash64(F.lit("lang"), F.col(id_col)), F.lit(1 << 20)) < F.element_at(chance, F.col(lang_col)) * (1 << 20))
    number = {k: i for i, k in enumerate(langs)}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, lang, part in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                text = text or ""
                words = text.split()
                at = len(text) % max(1, len(words))
                for t in (text, " ".join(words[at : at + 1 + len(text) % 6])):
                    b, w = features(t)
                    if len(b):
                        out.append((number[lang], part == 1, b.tobytes(), w.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["y", "held", "b", "w"])

    rows = drawn.select(text_col, lang_col, fold.cast("int")).mapInArrow(extract, "y long, held boolean, b binary, w binary").collect()
    data = sorted((r["held"], r["y"], bytes(r["b"]), bytes(r["w"])) for r in rows)
    made = [(h, y, np.frombuffer(b, "<u2").astype(np.int64), np.frombuffer(w, "<f4")) for h, y, b, w in data]
    return train([x[1:] for x in made if not x[0]] or [x[1:] for x in made], [x[1:] for x in made if x[0]], langs)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, lang_pred, score, rejected and the columns of `keep`) of every row; one pass, no shuffle."""
    share = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers
    part = 1 << 20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = share.value
        n_langs = len(model.langs)

        def sums(texts: list[str]) -> np.ndarray:
            """Summed scores and number of pieces of each text."""
            arrays = [clean_bytes(t) for t in texts]
            out = np.zeros((len(texts), n_langs + 1))
            starts = np.cumsum([0, *(len(a) for a in arrays)])
            for b, ok in piece_buckets(np.concatenate(arrays)):
                at = starts[:-1]
                ok = np.concatenate((ok, np.zeros(starts[-1] - len(ok), bool)))
                b = np.concatenate((b, np.zeros(starts[-1] - len(b), np.int64)))
                out[:, -1] += np.add.reduceat(ok.astype(np.int64), at)
                for k in range(n_langs):
                    out[:, k] += np.add.reduceat(np.where(ok, model.scores[:, k][b], np.float32(0)).astype(np.float64), at)
            return out

        for batch in batches:
            for lo, hi in slices(batch, "_text", part):
                rows = batch.slice(lo, hi - lo)
                texts = [t or "" for t in rows.column(0).to_pylist()]
                pieces, of = [], []
                for i, t in enumerate(texts):
                    for p in parts_of(t, part):
                        pieces.append(p)
                        of.append(i)
                total = np.zeros((len(texts), n_langs + 1))
                for at in range(0, len(pieces), 4096):
                    np.add.at(total, of[at : at + 4096], sums(pieces[at : at + 4096]))
                known = np.array([bool(_LETTER.search(t)) for t in texts]) & (n_langs > 0)
                pred, score = ["und"] * len(texts), np.zeros(len(texts))
                if n_langs:
                    p = model.probabilities(total[:, :-1] / np.maximum(1, total[:, -1:]))
                    best = p.argmax(axis=1)
                    score = np.where(known, p.max(axis=1), 0.0)
                    pred = [model.langs[b] if k else "und" for b, k in zip(best, known, strict=True)]
                rejected = ~known | (score < model.reject_below)
                yield pa.RecordBatch.from_arrays([*rows.columns[1:], pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)], names=[*rows.schema.names[1:], "lang_pred", "score", "rejected"])

    cols = [id_col, *keep]
    source = docs.select(F.col(text_col).alias("_text"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)])
    kinds = [docs.schema[c].dataType.simpleString() for c in cols]
    out = source.mapInArrow(run, ", ".join(f"_k{i} {k}" for i, k in enumerate(kinds)) + ", lang_pred string, score double, rejected boolean")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(cols)], "lang_pred", "score", "rejected")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a fifth of the documents is never learned from."""
    docs = table(spark, sf_dir, "documents")
    out = predict(docs, learn(docs))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
