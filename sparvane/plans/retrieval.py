"""Queries of text, vectors, digests and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import digest, search, vector
from ..runtime import shared_dir, table
from ..streaming import streams
from .registry import query

_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


@query(f"""SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM (SELECT doc_id, term, count(*) AS tf FROM
          (SELECT doc_id, unnest({_WORDS}) AS term FROM documents) GROUP BY ALL) GROUP BY term""")
def inverted_index(spark: SparkSession, d: str) -> DataFrame:
    return search.term_stats(table(spark, d, "documents"), "doc_id", "text")


_RANKED = f"""WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE len({_WORDS}) > 0),
           r AS (SELECT doc_id, len(w) AS dl, len(list_filter(w, lambda x: x = 'error')) AS tf0, len(list_filter(w, lambda x: x = 'webhooks')) AS tf1 FROM w),
           c AS (SELECT count(*) AS n, avg(dl) AS a, count(*) FILTER (WHERE tf0 > 0) AS d0, count(*) FILTER (WHERE tf1 > 0) AS d1 FROM r)
           SELECT doc_id, round(ln(1 + (n - d0 + 0.5::DOUBLE) / (d0 + 0.5::DOUBLE)) * tf0 * 2.2::DOUBLE / (tf0 + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / a))
                              + ln(1 + (n - d1 + 0.5::DOUBLE) / (d1 + 0.5::DOUBLE)) * tf1 * 2.2::DOUBLE / (tf1 + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / a)), 6) AS score
           FROM r, c WHERE tf0 > 0 OR tf1 > 0"""


@query(_RANKED)
def bm25_indexed(spark: SparkSession, d: str) -> DataFrame:
    index = search.SearchIndex(spark, f"{shared_dir(spark)}/index-{uuid.uuid4().hex[:8]}").build(table(spark, d, "documents"), "doc_id", "text")
    return index.search(["error", "webhooks"]).select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


@query(_RANKED)
def bm25_search(spark: SparkSession, d: str) -> DataFrame:
    scored = search.bm25(table(spark, d, "documents"), "doc_id", "text", ["error", "webhooks"])
    return scored.select("doc_id", F.round("score", 6).alias("score"))


@query("""SELECT doc_id, k AS pos, substr(text, k * 400 + 1, 500) AS chunk FROM
          (SELECT doc_id, text, unnest(range(0, greatest(length(text) - 101, 0) // 400 + 1)) AS k FROM documents WHERE length(text) > 0)""")
def chunk_fixed(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", text.chunk_fixed(F.col("text"), 500, 100).alias("c"))
    return rows.select("doc_id", F.posexplode("c").alias("pos", "chunk"))


@query()
def chunk_recursive(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", text.chunk_recursive(F.col("text"), 500, 50).alias("c"))
    return rows.select("doc_id", F.posexplode("c").alias("pos", "chunk"))


@query(r"""SELECT doc_id, k AS pos, array_to_string(t[k * 90 + 1 : k * 90 + 100], '') AS chunk FROM (SELECT doc_id, t, unnest(range(0, greatest(len(t) - 11, 0) // 90 + 1)) AS k FROM
           (SELECT doc_id, regexp_extract_all(text, '[\s\x0b]*(?:\p{L}+|\p{N}+|[^\s\x0b\p{L}\p{N}])') AS t FROM documents) WHERE len(t) > 0)""")
def chunk_tokens(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", text.chunk_tokens(F.col("text"), 100, 10).alias("c"))
    return rows.select("doc_id", F.posexplode("c").alias("pos", "chunk"))


_NEAR = """(SELECT q.vec_id AS query_id, b.vec_id AS id, b.label,
                   list_cosine_similarity(q.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score
            FROM embeddings q JOIN embeddings b ON q.vec_id % 50 = 0 AND q.vec_id <> b.vec_id)"""


@query(f"""SELECT query_id, id, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, id) AS rank
           FROM {_NEAR}) WHERE rank <= 10""")
def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings")
    return vector.top_k(rows, rows.where("vec_id % 50 = 0"), 10).select("query_id", "id", "rank")


@query("""SELECT label, pos::INT - 1 AS pos, round(avg(x::DOUBLE), 9) AS mean FROM
          (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL""")
def centroid(spark: SparkSession, d: str) -> DataFrame:
    return vector.centroid(table(spark, d, "embeddings"), ["label"]).withColumn("mean", F.round("mean", 9))


@query(f"""SELECT query_id, label AS predicted, votes FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, label) AS n FROM
           (SELECT query_id, label, count(*) AS votes FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, id) AS rank
            FROM {_NEAR}) WHERE rank <= 15 GROUP BY ALL)) WHERE n = 1""")
def knn_classify(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings")
    return vector.knn_classify(rows, rows.where("vec_id % 50 = 0"), 15)


@query("""WITH p AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
          c AS (SELECT label, pos, avg(x) AS m FROM p GROUP BY ALL),
          e AS (SELECT vec_id, c.label, sqrt(sum((x - m) * (x - m))) AS gap FROM p JOIN c USING (pos) GROUP BY ALL)
          SELECT vec_id, round(min(gap), 6) AS distance FROM e GROUP BY vec_id""")
def anomaly_distance(spark: SparkSession, d: str) -> DataFrame:
    return vector.centroid_distance(table(spark, d, "embeddings"), "label").withColumn("distance", F.round("distance", 6))


_RULES = [("financial_reports", ["invoices", "quotes"]), ("product_launches", ["new"]), ("industry_media", ["digest", "summaries"])]
_CATEGORY = """CASE WHEN contains(lower(text), 'invoices') OR contains(lower(text), 'quotes') THEN 'financial_reports'
                    WHEN contains(lower(text), 'new') THEN 'product_launches'
                    WHEN contains(lower(text), 'digest') OR contains(lower(text), 'summaries') THEN 'industry_media' ELSE 'unknown' END"""


@query(f"SELECT doc_id, {_CATEGORY} AS category FROM documents")
def rule_classify(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", digest.classify(F.col("text"), _RULES).alias("category"))


_COMPANY = f"""(SELECT DISTINCT doc_id, company FROM (SELECT doc_id, unnest({_WORDS}) AS token FROM documents) JOIN
               (SELECT DISTINCT unnest(integrations) AS company, lower(unnest(integrations)) AS token FROM workflows) USING (token))"""


@query(f"SELECT doc_id, company FROM {_COMPANY}")
def company_match(spark: SparkSession, d: str) -> DataFrame:
    return digest.match_companies(table(spark, d, "documents"), _companies(spark, d), "doc_id", "text")


def _companies(spark, d):
    names = table(spark, d, "workflows").select(F.explode("integrations").alias("company")).distinct()
    return names.select("company", F.lower("company").alias("token"))


def _records(spark, d):
    documents = table(spark, d, "documents").withColumnRenamed("source", "company")
    return documents.select(
        "doc_id", "company", digest.classify(F.col("text"), _RULES).alias("category"), F.date_format("collected_at", "yyyy-MM-dd").alias("publish_date")
    )


@query(f"SELECT count(*) AS total_count, count(DISTINCT {_CATEGORY}) AS category_count, count(DISTINCT source) AS company_count FROM documents")
def digest_counts(spark: SparkSession, d: str) -> DataFrame:
    return digest.digest_counts(_records(spark, d))


@query(f"""SELECT {_CATEGORY} AS category, source AS company, count(*) AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY strftime(collected_at, '%Y-%m-%d') NULLS FIRST, doc_id) AS ids
           FROM documents GROUP BY 1, 2""")
def digest_grouped(spark: SparkSession, d: str) -> DataFrame:
    groups = digest.digest_groups(_records(spark, d), ["publish_date", "doc_id"], ["doc_id"])
    return groups.select("category", "company", "n", F.array_join(F.transform("records", lambda x: x["doc_id"].cast("string")), ",").alias("ids"))


@query("""SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def tumbling_counts(spark: SparkSession, d: str) -> DataFrame:
    out = streams.tumbling_counts(table(spark, d, "events"), "ts", ["event_type"], "1 hour", "value")
    return out.withColumn("total", F.round("total", 4))


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
          s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e)
          SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS n FROM s GROUP BY user_id, k""")
def session_windows(spark: SparkSession, d: str) -> DataFrame:
    return streams.session_windows(table(spark, d, "events"), "ts", ["user_id"], "2 hours")


@query("""SELECT event_type, w AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT event_type, value,
                 unnest(generate_series(time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 18 HOUR, time_bucket(INTERVAL 6 HOUR, ts), INTERVAL 6 HOUR)) AS w FROM events) GROUP BY ALL""")
def sliding_counts(spark: SparkSession, d: str) -> DataFrame:
    out = streams.tumbling_counts(table(spark, d, "events"), "ts", ["event_type"], "24 hours", "value", slide="6 hours")
    return out.withColumn("total", F.round("total", 4))


def _stream(spark, d, name="events"):
    return streams.table_stream(spark, f"{d}/{name}.parquet", table(spark, d, name).schema)


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_counts(spark: SparkSession, d: str) -> DataFrame:
    counted = _stream(spark, d).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return streams.to_table(counted, "stream-counts", "complete")


@query("""SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    counted = streams.tumbling_counts(_stream(spark, d), "ts", ["event_type"], "1 day", "value")
    return streams.to_table(counted, "stream-tumbling", "complete").withColumn("total", F.round("total", 4))


@query("SELECT DISTINCT event_id FROM events")
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = _stream(spark, d)
    twice = rows.union(rows).withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.to_table(streams.stream_dedup(twice, ["event_id"], "ts", "60 days").select("event_id"), "stream-dedup")


@query("""SELECT run_id, test, error, coalesce(error LIKE 'timeout%', false) AS failed FROM timing""")
def error_stream(spark: SparkSession, d: str) -> DataFrame:
    """Both sides of the split, told apart by ``failed``."""
    good, bad = streams.split_to_tables(_stream(spark, d, "timing").select("run_id", "test", "error"), F.col("error").startswith("timeout"), "error-stream")
    return good.withColumn("failed", F.lit(False)).union(bad.withColumn("failed", F.lit(True)))


_LATE = 7


@query(f"""WITH r AS (SELECT *, event_type = 'purchase' AS second, time_bucket(INTERVAL 1 DAY, ts) AS day FROM events),
          m AS (SELECT date_trunc('milliseconds', max(ts) FILTER (WHERE NOT second)) - INTERVAL {_LATE} DAY AS w1, date_trunc('milliseconds', max(ts)) - INTERVAL {_LATE} DAY AS w2 FROM r)
          SELECT event_type, day AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM r, m
          WHERE day + INTERVAL 1 DAY <= w2 AND (NOT second OR day + INTERVAL 1 DAY > w1) GROUP BY ALL""")
def late_drop(spark: SparkSession, d: str) -> DataFrame:
    """Daily windows over two deliveries: purchases come after all else, so most of theirs were closed after the first, and those rows are dropped."""
    rows = table(spark, d, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    second = F.col("event_type") == "purchase"
    out = streams.deliver([rows.where(~second), rows.where(second)], lambda s: streams.tumbling_counts(s, "ts", ["event_type"], "1 day", "value", late=f"{_LATE} days"), "late-drop")
    return out.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n", F.round("total", 4).alias("total"))


@query(f"""SELECT query_id, id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY label, id) AS n FROM
           (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, id) AS rank FROM {_NEAR}) WHERE rank <= 10) WHERE n <= 3""")
def rerank(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings")
    near = vector.top_k(rows, rows.where("vec_id % 50 = 0"), 10).join(rows.selectExpr("vec_id AS id", "label"), "id")
    return vector.rerank(near, 3, -F.col("label")).select("query_id", "id")


@query("""SELECT source, count(*) AS n_records, CASE WHEN count(*) FILTER (WHERE text IS NULL) > 0 THEN 'no text' END AS errors
          FROM documents WHERE source IS NOT NULL GROUP BY source""")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("source is not null")
    return digest.run_summary(rows, rows.where("text is null").select("source", F.lit("no text").alias("error")))


@query("""SELECT event_type, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1""")
def percentiles(spark: SparkSession, d: str) -> DataFrame:
    at = lambda p: F.round(F.percentile("value", F.lit(p)), 6)
    return table(spark, d, "events").groupBy("event_type").agg(at(0.5).alias("median"), at(0.95).alias("p95"))
