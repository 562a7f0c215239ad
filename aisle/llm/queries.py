"""The registered queries of the subpackage: each applies one operator to its
whole table and derives the columns that are compared."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (audit, bpe, centroids, fingerprint, html_extract, language, mixing, ngram_join, pieces, quality, token_store, vector_join,
               warc)
from .common import remainder, scratch, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = BYTE_BPE) -> DataFrame:
    """Ids of every document and the text decoded from them, as digests."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = docs.select("doc_id", bpe.round_trip_column(F.col("text"), vocabulary).alias("r"))
    return both.select("doc_id", bpe.n_tokens(F.col("r.ids")).alias("n_tokens"),
                       F.sha2("r.ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("r.decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprint.with_next(_table(spark, sf_dir, "documents"), fingerprint.compare, fingerprint.COMPARED)


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from two thirds of the labels."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = quality.fit(docs, _table(spark, sf_dir, "labels"), ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), quality.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document at a similarity of 0.8."""
    return ngram_join.similarity_join(_table(spark, sf_dir, "documents"))


@query
def op7_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.95."""
    joined = vector_join.cosine_join(_table(spark, sf_dir, "embeddings"))
    return joined.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


@query
def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    weights = html_extract.fit(pages, "page_id", "html")
    text = pages.select("page_id", "url", html_extract.extract_column(F.col("html"), weights).alias("text"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


@query
def op9_token_store(spark: SparkSession, sf_dir: str, vocabulary: str = BYTE_BPE, end_id: int = 2) -> DataFrame:
    """Ids of every document with the end id, through the ORC store."""
    path = scratch(spark, "tokens")
    token_store.write_store(_table(spark, sf_dir, "documents"), path, vocabulary, end_id)
    return token_store.read_store(spark, path).select(
        "doc_id", "start", "n_tokens", token_store.ids_crc32(F.col("ids")).alias("ids_crc32"))


@query
def op2_warc(spark: SparkSession, sf_dir: str, min_bytes: int = 0) -> DataFrame:
    """A record per page, written as archives and read back."""
    path = scratch(spark, "warc")
    records = warc.classify(_table(spark, sf_dir, "pages"), "page_id", "html", "url", min_bytes)
    warc.write_archives(records, path, compression="none")  # files that readers split, so chains cross splits
    return warc.read_archives(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


ORACLE_SQL["op2_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hexed FROM p),
v AS (SELECT page_id, payload_bytes, hexed, min(page_id) OVER (PARTITION BY hexed) AS least,
             [CAST('0x' || substr(hexed, 5 * g + 1, 5) AS BIGINT) FOR g IN range(8)] AS groups FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                               CAST((groups[1 + i // 4] >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)
                        FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> least THEN least END AS refers_to
FROM v
"""


# sampling weights by the label of quality; unlabelled documents weigh 1
QUALITY_WEIGHTS = {1: 2.0, 0: 0.5}


def with_quality_weight(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``quality`` to (doc_id, ...); of repeated labels the least counts."""
    weight = F.min("quality").alias("label")
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(weight)
    return docs.join(known, "doc_id", "left").withColumn(
        "quality", F.when(F.col("label") == 1, QUALITY_WEIGHTS[1]).when(F.col("label") == 0, QUALITY_WEIGHTS[0])
        .otherwise(1.0)).drop("label")


@query
def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that a mix of all documents takes from each."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(with_quality_weight(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL["op3_mix"] = """
WITH lab AS (SELECT doc_id, min(quality) AS label FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT documents.doc_id, source,
             CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
             -ln((CAST('0x' || substr(md5('mix' || coalesce(CAST(documents.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5)
                 / 4503599627370496.0) / CASE label WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS key
      FROM documents LEFT JOIN lab ON documents.doc_id = lab.doc_id),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1]::DOUBLE AS w
        FROM d GROUP BY source),
-- sources by the level at which they are full: with the first k of them full,
-- the level is at least what the others then share, and the most of these
levels AS (SELECT *, 2.0 * source_size / w AS full_at,
                  coalesce(sum(2.0 * source_size) OVER o, 0.0) AS capped, sum(w) OVER () - coalesce(sum(w) OVER o, 0.0) AS open_w,
                  1.5 * sum(source_size) OVER () AS mix
           FROM src WINDOW o AS (ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
found AS (SELECT max((mix - capped) / open_w) AS level FROM levels),
plan AS (SELECT source, source_size, least(2.0 * source_size, w * level)::DOUBLE AS target FROM src, found),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM plan),
rest AS (SELECT *, CAST(round(target) AS BIGINT) - epochs * source_size AS rest FROM epochs),
placed AS (SELECT d.*, source_size, target, epochs, rest,
                  coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
           FROM d JOIN rest ON d.source IS NOT DISTINCT FROM rest.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - ahead)) AS BIGINT) AS taken
FROM placed
"""


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = language.fit(docs, ~held_out)
    return docs.select("doc_id", held_out.alias("held_out"), language.predict(F.col("text"), model).alias("p")) \
        .select("doc_id", "held_out", "p.lang_pred", "p.score")


FILTERS = "ABCDE"


def failing(docs: DataFrame) -> DataFrame:
    """doc_id, source, digest of the text, and whether each of the filters A
    to D fails it."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    one = docs.select("doc_id", "source", text.alias("text"), words.alias("words")).withColumn("n", F.size("words"))
    return one.select(
        "doc_id", "source", F.unhex(F.sha2("text", 256)).alias("digest"),
        (F.col("n") < 50).alias("A"),
        (100 * F.size(F.array_distinct("words")).cast("long") < 65 * F.col("n").cast("long")).alias("B"),
        (100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > 5 * F.length("text").cast("long")).alias("C"),
        F.col("text").rlike("[#$%&*|]").alias("D"))


@query
def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in all their orders, by source."""
    docs = stored(failing(_table(spark, sf_dir, "documents")), "fails")
    labels = (_table(spark, sf_dir, "labels").where("doc_id IS NOT NULL").groupBy("doc_id")
              .agg((F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic")))
    rows = audit.first_of_text(docs, "doc_id", "digest").withColumnRenamed("later", "E").join(labels, "doc_id", "left")
    found = audit.interactions(rows, "doc_id", "source", {f: f for f in FILTERS}, {"good": "good", "toxic": "toxic"})
    return found.withColumnsRenamed({"lost_good": "good_lost", "lost_toxic": "toxic_lost"})


ORACLE_SQL["op11_audit"] = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (SELECT doc_id, part,
             CAST(len(words) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 65 * len(words) AS INT)
             + 4 * CAST(100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) AS INT)
             + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
             + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS INT) AS mask
      FROM t),
l AS (SELECT doc_id, CAST(max(quality) = 1 AS INT) AS good, CAST(max(toxic) = 1 AS INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS ch, unnest([1, 2, 4, 8, 16]) AS b),
o AS (SELECT x1.ch || x2.ch || x3.ch || x4.ch || x5.ch AS filter_order, [x1.b, x2.b, x3.b, x4.b, x5.b] AS bits
      FROM x x1, x x2, x x3, x x4, x x5
      WHERE x1.b + x2.b + x3.b + x4.b + x5.b = 31 AND x1.b | x2.b | x3.b | x4.b | x5.b = 31),
s AS (SELECT filter_order, step, bits[step] AS b, list_sum(list_concat([0], bits[:step - 1]))::INT AS earlier
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
c AS (SELECT part, filter_order, CAST(step AS INT) AS step, b,
             coalesce(sum(n) FILTER (mask & (b | earlier) = 0), 0) AS kept,
             coalesce(sum(n) FILTER (mask & b <> 0 AND mask & earlier = 0), 0) AS removed,
             coalesce(sum(n) FILTER (mask & b <> 0 AND mask & earlier <> 0), 0) AS redundant,
             coalesce(sum(n) FILTER (mask = b), 0) AS unique_fails,
             coalesce(sum(good) FILTER (mask & b <> 0 AND mask & earlier = 0), 0) AS good_lost,
             coalesce(sum(toxic) FILTER (mask & b <> 0 AND mask & earlier = 0), 0) AS toxic_lost
      FROM m, s GROUP BY part, filter_order, step, b)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, b) AS BIGINT) AS shapley
FROM c
"""


@query
def op12_pieces(spark: SparkSession, sf_dir: str, vocabulary: str = PIECE_BPE) -> DataFrame:
    """Ids of every document and the text decoded from them, as digests."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = docs.select("doc_id", pieces.round_trip_column(F.col("text"), vocabulary, check=True).alias("r"))
    listed = F.array_join(F.col("r.ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("r.ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                       F.sha2("r.decoded", 256).alias("decoded_sha256"))


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty clusters of the vectors after five rounds."""
    found = centroids.cluster(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k=40, rounds=5, dimensions=64)
    return found.drop("centroid")


def _rounds_sql(k: int, rounds: int, dimensions: int) -> str:
    parts = [f"""v AS (SELECT row_number() OVER () AS r, vec_id, a FROM (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS a FROM embeddings
      WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), a) - 1 AS INT) AS c, a AS w
       FROM v ORDER BY sha256('2:' || vec_id), a LIMIT {k})"""]
    nearest = """SELECT r, vec_id, a, first(c ORDER BY d, c) AS c, min(d) AS d FROM (
      SELECT r, vec_id, a, c, CAST(list_sum(list_transform(list_zip(a, w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
      FROM v, c{i}) GROUP BY r, vec_id, a"""
    for i in range(rounds):
        parts.append(f"n{i} AS ({nearest.format(i=i)})")
        parts.append(f"""m{i} AS (SELECT c, list(m ORDER BY i) AS w FROM (
      SELECT c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
      FROM (SELECT c, unnest(a) AS x, unnest(range({dimensions})) AS i FROM n{i}) GROUP BY c, i) GROUP BY c)""")
        parts.append(f"c{i + 1} AS (SELECT c, coalesce(m.w, o.w) AS w FROM c{i} o LEFT JOIN m{i} m USING (c))")
    parts.append(f"last AS ({nearest.format(i=rounds)})")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM last JOIN c{rounds} USING (c)"""


ORACLE_SQL["op13_centroids"] = _rounds_sql(40, 5, 64)
