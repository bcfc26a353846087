"""From documents to packed training sequences, in five stages; each works on all that its predecessor kept.

1. language_id: documents without a letter, or with a language that is too uncertain, go.
2. jaccard_join: of each group of documents linked by five-word shingles at a Jaccard similarity of 0.8 the one of smallest id stays (rows without an id stay).
3. suffix_dedup: stretches of 400 bytes that repeat are cut from the texts; a text with nothing left goes.
4. decontamination: documents that hold a benchmark item go.
5. best_fit_packing: the rest is tokenized and packed.

A row is its id with a hash of its text, so rows that share an id are told apart; equal rows are copies, of which one stays in stage 2.
All stages but the last return the columns that they were given, whatever their names (n_chars, where there is one, follows the text);
an empty table gives empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimloom.llm.common import saved, ship_package, small, table
from dimloom.llm.decontaminate import found_items
from dimloom.llm.jaccard_join import similar_groups
from dimloom.llm.language_id import learn, predict
from dimloom.llm.packing import pack_documents
from dimloom.llm.suffix_dedup import remove_repeats

#: No SQL can train a classifier or sort suffixes; tests hold the stages against brute force.
ORACLE_SQL = None
#: Stage 2 links documents by five-word shingles at a Jaccard similarity of 0.8 (op7's query has its own contract).
SHINGLE_WORDS, SHINGLE_PERCENT = 5, 80

def _row() -> Column:
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))


def _named(docs: DataFrame) -> str:
    """A name for rows that no column of docs has."""
    name = "_row"
    while name in docs.columns:
        name += "_"
    return name


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs without the given rows (key): broadcast if they are few and small."""
    name = _named(docs)
    keyed, gone = docs.withColumn(name, _row()), small(rows).select(F.col(rows.columns[0]).alias(f"{name}gone"))
    return keyed.join(gone, F.col(name).eqNullSafe(F.col(f"{name}gone")), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts go to Python once, and only the keys of rejected rows come back."""
    ship_package(spark)
    judged = predict(docs.select(_row().alias("key"), "text"), learn(docs), id_col="key")
    return _without(docs, saved(judged.filter("rejected").select("key").distinct(), "rejected"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    rows = similar_groups(docs.select(_row().alias("key"), "text"), k=SHINGLE_WORDS, percent=SHINGLE_PERCENT, id_col="key")
    known = rows.filter("key.id is not null")
    goes = saved(known.filter("key != component_id").select("key").distinct(), "linked")
    twice = saved(known.filter("key = component_id").groupBy("key").count().filter("count > 1").select("key"), "equal-rows")
    kept = _without(docs, goes)
    if twice.isEmpty():
        return kept
    # equal rows: one of them stays
    name = _named(docs)
    several = kept.withColumn(name, _row()).join(small(twice.select(F.col("key").alias(name))), name, "left_semi").dropDuplicates([name])
    return _without(kept, twice).unionByName(several.drop(name))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rest = F.struct(*[F.col(f"`{c}`").alias(place[c]) for c in docs.columns if c != "text"])
    cut = remove_repeats(docs.select(rest.alias("_rest"), "text"), id_col="_rest")
    columns = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    out = cut.filter("kept_text != ''")
    return out.select(*[(columns[c] if c in columns else F.col(f"_rest.{place[c]}")).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = found_items(docs.select(_row().alias("key"), "text"), table(spark, sf_dir, "benchmark"), id_col="key")
    return _without(docs, saved(found.select("key").distinct(), "contaminated"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written to shared storage and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
