"""Full-text search: token match, postings, and BM25 ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """The lower-cased runs of letters and digits of a text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def match_term(df: DataFrame, text: str, term: str) -> DataFrame:
    """Rows that have ``term`` as a whole token; letter case does not matter."""
    term = term.lower()
    # The substring test is cheap and spares most rows the tokenising.
    return df.where(F.lower(F.col(text)).contains(term) & F.array_contains(tokens(F.col(text)), term))


def postings(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``(term, id, tf)``: the inverted index. Combined before the shuffle, so common terms cost little."""
    return df.select(F.col(id_col), F.explode(tokens(F.col(text))).alias("term")).groupBy("term", id_col).agg(F.count("*").alias("tf"))


def write_postings(index: DataFrame, path: str, buckets: int = 64) -> None:
    """The index as a table partitioned by a hash of the term, so that a search reads one partition."""
    index.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")).write.partitionBy("bucket").parquet(path)


def look_up(index: DataFrame, term: str, buckets: int = 64) -> DataFrame:
    bucket = F.pmod(F.xxhash64(F.lit(term.lower())), F.lit(buckets)).cast("int")
    return index.where((F.col("bucket") == bucket) & (F.col("term") == term.lower()))


class SearchIndex:
    """A ranked search's index below ``path``: postings with their text's length by a hash of the term, and the corpus's figures.

    A search reads the partitions of its terms only; texts are tokenised once, when the index is built.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def build(self, df: DataFrame, id_col: str, text: str) -> SearchIndex:
        words = df.select(F.col(id_col).alias("id"), tokens(F.col(text)).alias("w")).where(F.size("w") > 0)
        rows = words.select("id", F.size("w").alias("dl"), F.explode("w").alias("term")).groupBy("term", "id", "dl").agg(F.count("*").alias("tf"))
        write_postings(rows, f"{self.path}/postings", self.buckets)
        words.agg(F.count("*").alias("n"), F.avg(F.size("w")).alias("avgdl")).write.parquet(f"{self.path}/corpus")
        return self

    def search(self, query: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
        """``(id, score)`` by Okapi BM25 of the texts with any query term."""
        index = self.spark.read.parquet(f"{self.path}/postings")
        found = None
        for term in sorted({t.lower() for t in query}):
            rows = look_up(index, term, self.buckets).select("id", "tf", "dl", "term")
            found = rows if found is None else found.union(rows)
        often = found.groupBy("term").agg(F.count("*").alias("d"))  # a row per query term
        scored = found.join(F.broadcast(often), "term").crossJoin(F.broadcast(self.spark.read.parquet(f"{self.path}/corpus")))  # one row
        idf = F.log(1 + (F.col("n") - F.col("d") + 0.5) / (F.col("d") + 0.5))
        score = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
        return scored.groupBy("id").agg(F.sum(score).alias("score"))


def term_stats(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``(term, df, cf)``: in how many texts, and how often in all, each term occurs."""
    return postings(df, id_col, text).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def bm25(df: DataFrame, id_col: str, text: str, query: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """``(id, score)`` of the texts with any query term, by Okapi BM25 over the whole table.

    Two passes over the texts, for the corpus figures (one row) and the scores; no shuffle of texts.
    """
    terms = sorted({t.lower() for t in query})
    words = df.select(F.col(id_col), tokens(F.col(text)).alias("w")).where(F.size("w") > 0)
    often = lambda term: F.size(F.filter("w", lambda w: w == term))
    counts = [often(t).alias(f"tf{k}") for k, t in enumerate(terms)]
    rows = words.select(id_col, F.size("w").alias("dl"), *counts)
    corpus = rows.agg(
        F.count("*").alias("n"), F.avg("dl").alias("avgdl"), *[F.count_if(F.col(f"tf{k}") > 0).alias(f"df{k}") for k in range(len(terms))]
    )
    score = F.lit(0.0)
    for k in range(len(terms)):
        tf, d = F.col(f"tf{k}"), F.col(f"df{k}")
        idf = F.log(1 + (F.col("n") - d + 0.5) / (d + 0.5))
        score = score + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    found = rows.where(" or ".join(f"tf{k} > 0" for k in range(len(terms)))).crossJoin(F.broadcast(corpus))  # one row
    return found.select(id_col, score.alias("score"))
