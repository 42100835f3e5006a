"""Corpus cleaning from documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns the
columns of documents; the last returns packed pieces. Decisions travel as small tables of doc_id
and a hash of the text; texts are shuffled only where that table is too large to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.llm import exact_dedup, language, minhash, packing, pii
from fleetmeter.llm.support import BROADCAST_IDS
from fleetmeter.session import spill_to_table

#: Word shingles and similarity (in percent) of near duplicates.
NEAR_WORDS, NEAR_PERCENT = 5, 80


#: Languages to keep (None: all that were learnt), and the least score of any kept text. Short texts in a learnt language score
#: as low as 0.03 and unknown scripts up to 0.1, so no score tells them apart and the default rejects none.
LANGUAGES, LEAST_SCORE = None, 0.0
#: From so many letter n-grams on a score does tell: at sf0.1 the texts of 200 letters that scored below 0.33 (looked at one by one)
#: were words over and over, and a text in no learnt language scores less than this. It takes profiles from so many labelled documents.
LONG_GRAMS, LONG_SCORE, LEARNT_FROM = 200, 0.25, 100
#: Letters that no profile holds make vectors at random to all of them, so such a text scores less than four standard deviations at any length
#: (0.119 at most over 10,500 made-up texts in seven scripts). Whole texts of 100 to 200 n-grams score 0.24 or more (sf0.1, check_l), shorter ones less.
LEAST_GRAMS, UNLEARNT_SCORE = 100, 4 / language.DIMENSIONS**0.5


def _name(low: bool = False) -> Column:
    """doc_id, or for a row without one a number of its text, far above all ids or far below them."""
    return F.coalesce(F.col("doc_id").cast("long"), _spare(low))


def _spare(low: bool = False) -> Column:
    return F.xxhash64("text").bitwiseAND(2**61 - 1) + F.lit(-(2**62) if low else 2**62)


def _named(docs: DataFrame, low: bool = False) -> DataFrame:
    return docs.select(_name(low).alias("doc_id"), "text")


def _split(docs: DataFrame, marks: DataFrame, how: str, low: bool = False) -> DataFrame:
    """Rows of docs whose name and text hash stand in marks (left_semi) or don't (left_anti), and with
    "inner" the marks' other columns as well. Names that begin with two underscores are the marks'."""
    named = marks.select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), *[
        F.col(c).alias(f"__{c}") for c in marks.columns if c not in ("doc_id", "row")])
    if marks.count() <= BROADCAST_IDS:
        named = F.broadcast(named)
    return docs.join(named, (_name(low) == F.col("__id")) & (F.xxhash64("text") == F.col("__row")), how)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without any letter, and with labels to learn from those in no learnt language (texts of LEAST_GRAMS n-grams
    that score below UNLEARNT_SCORE, and of LONG_GRAMS below LONG_SCORE), of a language outside LANGUAGES, or below LEAST_SCORE.

    A null or empty text has no letter; rows without doc_id, repeated rows and ties are judged like all others, long texts
    whole. Where nothing can be learnt (no label), only texts without letters go; with fewer than LEARNT_FROM labelled rows
    profiles are too thin for UNLEARNT_SCORE and LONG_SCORE. An empty table stays empty.
    """
    found = language.identify(docs)
    foreign = F.col("score") < LEAST_SCORE
    if docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").count() >= LEARNT_FROM:
        for grams, score in ((LEAST_GRAMS, UNLEARNT_SCORE), (LONG_GRAMS, LONG_SCORE)):
            foreign = foreign | ((F.col("grams") >= grams) & (F.col("score") < score))
    if LANGUAGES is not None:
        foreign = foreign | ~F.col("lang_pred").isin(list(LANGUAGES))
    rejected = found.where(~F.col("letters") | ((F.col("lang_pred") != language.UNKNOWN) & foreign))
    marks = rejected.select(F.coalesce("doc_id", F.col("row").bitwiseAND(2**61 - 1) + F.lit(2**62)).alias("doc_id"), "row").distinct()
    return _split(docs, spill_to_table(marks, "rejected"), "left_anti")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the row with the largest doc_id, once if it is repeated; any doc_id wins over none.

    A null text equals an empty one. Texts of any length are compared whole; an empty table stays empty.
    """
    decided = spill_to_table(exact_dedup.exact_dedup(_named(docs, low=True), keep="largest").select("doc_id", "row", "kept"), "decided")
    repeated = spill_to_table(decided.where("kept").groupBy("doc_id", "row").count().where("count > 1").select("doc_id", "row"), "repeated")
    dropped = spill_to_table(decided.where("NOT kept").select("doc_id", "row").distinct(), "dropped")
    kept = _split(docs, dropped, "left_anti", low=True)
    once = _split(kept, repeated, "left_semi", low=True).dropDuplicates(["doc_id", "text"])
    return _split(kept, repeated, "left_anti", low=True).unionByName(once)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates keep the document with the smallest doc_id, any doc_id before none, the smaller
    text hash at ties.

    Documents that share a doc_id but not their text are documents of their own. Null and empty texts are like nothing
    else; texts of any length count whole; an empty table stays empty.
    """
    ids = docs.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("__shared")).count().where("count > 1").select("__shared")
    shared = spill_to_table(ids, "shared-ids")
    node, several = _name(), shared.count()
    nodes = docs
    if several:
        nodes = docs.join(F.broadcast(shared) if several <= BROADCAST_IDS else shared, F.col("doc_id") == F.col("__shared"), "left")
        node = F.when(F.col("__shared").isNotNull(), _spare()).otherwise(_name())
    found = spill_to_table(minhash.near_duplicates(nodes.select(node.alias("doc_id"), "text"), NEAR_WORDS, NEAR_PERCENT).select("doc_id", "component_id", "kept"), "near")
    dropped = found.where("NOT kept").select(F.col("doc_id").alias("__node"))
    if several:  # a node's number may lie beyond its doc_id then, so the first of a group is chosen by doc_id itself
        own = nodes.select(node.alias("__node"), F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.xxhash64("text").alias("c"), node.alias("node")).alias("__order"))
        groups = found.join(found.where("NOT kept").select("component_id").distinct(), "component_id").join(own, F.col("doc_id") == F.col("__node"))
        first = groups.groupBy("component_id").agg(F.min("__order")["node"].alias("__node"))
        dropped = groups.select("__node").join(first.select("__node"), "__node", "left_anti")
    dropped = spill_to_table(dropped.distinct(), "near-dropped")
    gone = F.broadcast(dropped) if dropped.count() <= BROADCAST_IDS else dropped
    return nodes.join(gone, node == F.col("__node"), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the name of its kind; n_chars follows the new text.

    Spans that overlap are cut as one. Null texts stay null; long texts are searched whole; rows without doc_id are
    cleaned too; an empty table stays empty.
    """
    found = pii.find_pii(_named(docs)).where(F.size("spans") > 0).select("doc_id", "row", "spans").dropDuplicates(["doc_id", "row"])
    found = spill_to_table(found, "pii")
    clean = _split(docs, found.select("doc_id", "row"), "left_anti")
    dirty = _split(docs, found.select("doc_id", "row"), "left_semi")
    named = found.select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), F.col("spans").alias("__spans"))
    dirty = dirty.join(named, (_name() == F.col("__id")) & (F.xxhash64("text") == F.col("__row")))
    dirty = dirty.withColumn("text", pii.redacted(F.col("text"), F.col("__spans")))
    if "n_chars" in docs.columns:
        dirty = dirty.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.unionByName(dirty.select(*[F.col(f"`{c}`") for c in docs.columns]))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens; one row per piece of a document, with or without doc_id. A null text is empty; ties go as
    ``packing.pack`` says."""
    return packing.pack(docs)


STAGES = [
    ("language", known_language),
    ("exact_dedup", distinct_texts),
    ("near_dedup", distinct_documents),
    ("pii", without_pii),
    ("packing", packed),
]

#: Packing needs a tokenizer, near duplicates a transitive closure over shingles: no SQL for the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what one returns is a table in the shared folder before the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = spill_to_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
