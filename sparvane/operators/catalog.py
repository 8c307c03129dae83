"""Statistics over a catalog: counts, histograms, validity and bucketed scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def histogram_map(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row with a map of each non-null value to its count; for columns of few values."""
    counts = histogram(df.where(F.col(column).isNotNull()), column)
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "n")))).alias(name))


def catalog_stats(rows: DataFrame) -> DataFrame:
    """Totals, active and inactive rows, distinct integrations, nodes, last indexing, and both histograms: one row from one scan.

    Each row is counted once as a row, once for its trigger type and complexity, and once per integration;
    counts are combined before they are shuffled.
    """
    def told(kind, value):
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))

    own = F.array(told("row", F.lit(None)), told("trigger", F.col("trigger_type")), told("complexity", F.col("complexity")))
    some = F.transform(F.coalesce(F.array_distinct("integrations"), F.array().cast("array<string>")), lambda x: told("integration", x))
    items = rows.select("active", F.col("node_count").cast("long").alias("nodes"), "last_indexed", F.explode(F.concat(own, some)).alias("x"))
    of_rows = F.col("x.kind") == "row"
    counted = items.groupBy("x.kind", "x.value").agg(
        F.count("*").alias("n"), F.count_if(of_rows & F.col("active")).alias("active"), F.count_if(of_rows & ~F.col("active")).alias("inactive"),
        F.sum(F.when(of_rows, F.col("nodes"))).alias("nodes"), F.max("last_indexed").alias("last_indexed"),
    )
    kind, valued = F.col("kind"), F.col("value").isNotNull()
    zero = lambda c: F.coalesce(c, F.lit(0))

    def histogram_of(name):
        return F.map_from_entries(F.array_sort(F.collect_list(F.when((kind == name) & valued, F.struct("value", "n")))))

    return counted.agg(
        zero(F.sum(F.when(kind == "row", F.col("n")))).alias("total"),
        zero(F.sum("active")).alias("active"),
        zero(F.sum("inactive")).alias("inactive"),
        F.count_if((kind == "integration") & valued & (F.col("value") != "")).alias("unique_integrations"),
        zero(F.sum("nodes")).alias("total_nodes"),
        F.max("last_indexed").alias("last_indexed"),
        histogram_of("trigger").alias("triggers"),
        histogram_of("complexity").alias("complexity"),
    )


def validity(files: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Per file: whether it has a name, a list of nodes and an object of connections, and all three; and the columns to ``keep``.

    An empty name is no name. The number of connections is that of the object's fields.
    """
    keys = F.json_object_keys("connections")
    return files.select(
        "file_id",
        *(keep or []),
        F.coalesce("name", F.lit("Unnamed")).alias("name"),
        F.coalesce(F.when(F.size("nodes") >= 0, F.size("nodes")), F.lit(0)).alias("n_nodes"),
        F.coalesce(F.when(F.size(keys) >= 0, F.size(keys)), F.lit(0)).alias("n_connections"),
        F.coalesce(F.col("name") != "", F.lit(False)).alias("has_name"),
        F.col("nodes").isNotNull().alias("has_nodes"),
        F.coalesce(keys.isNotNull(), F.lit(False)).alias("has_connections"),
    ).withColumn("valid", F.col("has_name") & F.col("has_nodes") & F.col("has_connections"))


def verdict(valid: Column, total: Column, most: float = 0.8) -> Column:
    """``all``, ``most`` (a share strictly above the limit) or ``some`` of the samples are valid; null for none at all."""
    return F.when(total == 0, None).when(valid == total, "all").when(valid > total * most, "most").otherwise("some")


def mean_of_passed(rows: DataFrame, by: list[str], always: list[str], optional: list[str], kind: str = "test", value: str = "elapsed_ms", ok: str = "ok") -> DataFrame:
    """``(by, average)``: the mean over one figure per kind (its mean); optional kinds count only where one of their rows passed."""
    per = rows.where(F.col(kind).isin(*always, *optional)).groupBy(*by, kind).agg(F.avg(value).alias("_v"), F.max(ok).alias("_ok"))
    counts = F.col(kind).isin(*always) | F.coalesce("_ok", F.lit(False))
    return per.groupBy(*by).agg(F.avg(F.when(counts, F.col("_v"))).alias("average"))


def success_rate(df: DataFrame, by: list[str], ok: Column) -> DataFrame:
    """Rows, successes and their percentage per group; 0 for an empty whole."""
    out = df.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(ok).alias("valid"))
    return out.withColumn("rate", F.when(F.col("total") > 0, 100.0 * F.col("valid") / F.col("total")).otherwise(0.0))


def grade(value: Column, limits: list[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first limit that the value is strictly under; null for null."""
    out = F.lit(otherwise)
    for limit, label in reversed(limits):
        out = F.when(value < limit, label).otherwise(out)
    return F.when(value.isNotNull(), out)


def improvement(before: Column, after: Column) -> Column:
    """Change in percent of ``before``; null where that is 0."""
    return F.try_divide((after - before) * 100.0, before)


#: Node counts up to which a workflow is simple, and moderate; fixed values of the corpus.
SIMPLE, MODERATE = 5, 15


def complexity(nodes: Column, labels: tuple[str, str, str] = ("Simple", "Moderate", "Complex")) -> Column:
    small, middle, large = labels
    return F.when(nodes <= SIMPLE, small).when(nodes <= MODERATE, middle).when(nodes.isNotNull(), large)


def time_bucket(nodes: Column) -> Column:
    return complexity(nodes, ("1-5 seconds", "5-30 seconds", "30+ seconds"))


def is_trigger(node_type: Column) -> Column:
    """Whether a node type starts runs: its name contains trigger, webhook or cron."""
    return F.lower(node_type).rlike("trigger|webhook|cron")


#: Brands that count as integrations; fixed values of the corpus.
BRANDS = ("google", "slack", "microsoft", "github", "hubspot", "zendesk", "stripe", "salesforce")


def node_profile(files: DataFrame) -> DataFrame:
    """Per file: nodes, trigger nodes (a bag), processing nodes, error handling, distinct types, brands."""
    types = F.transform("nodes", lambda n: n["type"])
    lower = F.transform(types, F.lower)
    has = lambda brand: F.exists(lower, lambda t: t.contains(brand))
    brands = F.array(*[F.when(has(b), F.lit(b)) for b in BRANDS])
    n_nodes = F.when(F.size("nodes") >= 0, F.size("nodes")).otherwise(0)
    triggers = F.coalesce(F.size(F.filter(types, is_trigger)), F.lit(0))
    triggers = F.when(triggers > 0, triggers).otherwise(0)
    return files.select(
        "file_id",
        n_nodes.alias("n_nodes"),
        triggers.alias("n_triggers"),
        (n_nodes - triggers).alias("n_processing"),
        F.coalesce(F.exists(lower, lambda t: t.rlike("stop(and|with)error|errortrigger")), F.lit(False)).alias("handles_errors"),
        F.coalesce(F.when(F.size("nodes") >= 0, F.size(F.array_distinct(types))), F.lit(0)).alias("n_types"),
        F.array_join(F.array_compact(brands), ",").alias("brands"),
        complexity(n_nodes).alias("complexity"),
    )
