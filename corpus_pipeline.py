"""Corpus pipeline: quality, language, near copies, mixture, tokens.

``STAGES`` names five stages, each a function of (session, documents, folder
of the tables) that calls one operator of ``aisle.llm`` on all that the stage
before kept.  All but the last return the columns of their input.

Rows without an id pass the filters like any other; no link leads to them,
and the mixture, which draws by id, leaves them out.  Rows that repeat an id
count as copies: the third stage keeps one.  Empty tables pass as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aisle.llm import bpe, language, mixing, ngram_join, quality
from aisle.llm.common import scratch
from aisle.llm.queries import BYTE_BPE, with_quality_weight

LEAST_QUALITY = 0.5
# below this cosine a text resembles no language that was learned
LEAST_LIKENESS = 0.1


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, learned from the labels of these
    documents, does not reject."""
    model = quality.fit(docs, _labels(spark, sf_dir), F.lit(True))
    return docs.where(quality.score(F.col("text"), model) >= LEAST_QUALITY)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language of the documents; those without
    a letter, and those like no language, go.  Where no document has a
    language nothing is learned and nothing goes."""
    model = language.fit(docs, F.lit(True))
    if not model[0]:
        return docs
    found = language.predict(F.col("text"), model)
    return docs.where((found["lang_pred"] != language.UNKNOWN) & (found["score"] >= LEAST_LIKENESS))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that of the least id."""
    joined = ngram_join.similarity_join(docs)
    copies = joined.where("doc_id <> class_id").select("doc_id")
    kept = docs.join(copies, "doc_id", "left_anti")
    again = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    return kept.withColumn("_again", again).where("_again = 1 OR doc_id IS NULL").select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the one document of a
    source that is taken in part stays whole if that is half of it at least."""
    sizes = docs.where("doc_id IS NOT NULL").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(with_quality_weight(sizes, _labels(spark, sf_dir)))
    copies = (mixed.where("taken > 0").groupBy("doc_id")
              .agg(F.max(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("int").alias("_copies")).where("_copies > 0"))
    return (docs.join(copies, "doc_id").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(*docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document (little-endian unsigned 32-bit integers), and
    whether they decode to its text."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", "source", text.alias("text"), bpe.round_trip_column(text, BYTE_BPE).alias("r"))
    return rows.select("doc_id", "lang", "source", bpe.n_tokens(F.col("r.ids")).alias("n_tokens"), F.col("r.ids").alias("ids"),
                       (F.col("r.decoded") == F.col("text")).alias("decodes"))


STAGES = [
    ("quality classifier", good_quality),
    ("language identification", known_language),
    ("n-gram Jaccard join", no_near_copies),
    ("mixing sources", mixed_sources),
    ("BPE encoding and decoding", tokens),
]

# learned models and MinHash sketches are not for SQL; tests/llm compares the
# stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each one's result written as Parquet
    and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = scratch(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
