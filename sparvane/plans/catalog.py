"""Catalog queries: scans, filters, full-text search, statistics, scalar rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arithmetic, codes, text
from ..operators import catalog, search
from ..runtime import table
from .registry import query

_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


@query("SELECT count(*) AS n FROM workflows")
def count_all(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "workflows").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, lang, source, n_chars FROM documents WHERE list_contains({_WORDS}, 'webhooks')")
def fts_search(spark: SparkSession, d: str) -> DataFrame:
    return search.match_term(table(spark, d, "documents"), "text", "webhooks").select("doc_id", "lang", "source", "n_chars")


@query(f"""SELECT doc_id, doc_kind FROM documents WHERE doc_kind IN ('api_doc', 'usage_guide')
           AND (list_contains({_WORDS}, 'webhooks') OR list_contains({_WORDS}, 'triggers'))""")
def search_any_term(spark: SparkSession, d: str) -> DataFrame:
    some = table(spark, d, "documents").where(F.col("doc_kind").isin("api_doc", "usage_guide"))
    found = F.arrays_overlap(search.tokens(F.col("text")), F.array(F.lit("webhooks"), F.lit("triggers")))
    return some.where(found).select("doc_id", "doc_kind")


@query("""SELECT wf_id, filename, name FROM workflows WHERE trigger_type = 'Webhook' AND complexity = 'medium'
          ORDER BY wf_id, loaded_at, last_indexed, filename, name LIMIT 20""")
def filter_and(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "workflows").where((F.col("trigger_type") == "Webhook") & (F.col("complexity") == "medium"))
    order = [F.col(c).asc_nulls_last() for c in ("wf_id", "loaded_at", "last_indexed", "filename", "name")]
    return rows.orderBy(*order).limit(20).select("wf_id", "filename", "name")


@query("SELECT wf_id, filename, category FROM workflows WHERE category = 'Messaging & Alerts'")
def filter_category(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "workflows").where(F.col("category") == "Messaging & Alerts").select("wf_id", "filename", "category")


@query("SELECT wf_id, filename, name, trigger_type FROM workflows")
def project_scan(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "workflows").select("wf_id", "filename", "name", "trigger_type")


_HISTOGRAM = "(SELECT string_agg({0} || '=' || n, ',' ORDER BY {0}) FROM (SELECT {0}, count(*) AS n FROM workflows WHERE {0} IS NOT NULL GROUP BY 1))"


@query(f"""SELECT count(*) AS total, count(*) FILTER (WHERE active) AS active, count(*) FILTER (WHERE NOT active) AS inactive,
                  (SELECT count(DISTINCT i) FROM (SELECT unnest(integrations) AS i FROM workflows) WHERE i <> '') AS unique_integrations,
                  sum(node_count)::BIGINT AS total_nodes, max(last_indexed) AS last_indexed, {_HISTOGRAM.format("trigger_type")} AS triggers,
                  {_HISTOGRAM.format("complexity")} AS complexity FROM workflows""")
def stats_summary(spark: SparkSession, d: str) -> DataFrame:
    stats = catalog.catalog_stats(table(spark, d, "workflows"))
    told = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias(c)
    return stats.select(*[c for c in stats.columns if c not in ("triggers", "complexity")], told("triggers"), told("complexity"))


@query("SELECT trigger_type, count(*) AS n FROM workflows WHERE trigger_type IS NOT NULL GROUP BY 1")
def hist_map(spark: SparkSession, d: str) -> DataFrame:
    one = catalog.histogram_map(table(spark, d, "workflows"), "trigger_type", "m")
    return one.select(F.explode("m").alias("trigger_type", "n"))


@query("""SELECT wf_id, node_count, CASE WHEN node_count <= 5 THEN 'Simple' WHEN node_count <= 15 THEN 'Moderate'
                 WHEN node_count IS NOT NULL THEN 'Complex' END AS complexity_class,
                 CASE WHEN node_count <= 5 THEN '1-5 seconds' WHEN node_count <= 15 THEN '5-30 seconds'
                 WHEN node_count IS NOT NULL THEN '30+ seconds' END AS time_bucket FROM workflows""")
def complexity_bucket(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("node_count")
    rows = table(spark, d, "workflows")
    return rows.select("wf_id", "node_count", catalog.complexity(n).alias("complexity_class"), catalog.time_bucket(n).alias("time_bucket"))


_VALID = """(SELECT file_id, repo, coalesce(name, 'Unnamed') AS name, coalesce(len(nodes), 0)::INT AS n_nodes, coalesce(name <> '', false) AS has_name,
                     nodes IS NOT NULL AS has_nodes, o IS NOT NULL AS has_connections, coalesce(len(json_keys(o)), 0)::INT AS n_connections,
                     coalesce(name <> '', false) AND nodes IS NOT NULL AND o IS NOT NULL AS valid FROM
              (SELECT *, CASE WHEN json_valid(connections) THEN CASE WHEN json_type(connections) = 'OBJECT' THEN connections::JSON END END AS o FROM workflow_json))"""


@query(f"SELECT * EXCLUDE (repo) FROM {_VALID}")
def structure_check(spark: SparkSession, d: str) -> DataFrame:
    return catalog.validity(table(spark, d, "workflow_json"))


@query(f"""SELECT repo, count(*) AS total, count(*) FILTER (WHERE valid) AS valid, CASE WHEN count(*) FILTER (WHERE valid) = count(*) THEN 'all'
                  WHEN count(*) FILTER (WHERE valid) > count(*) * 0.8 THEN 'most' ELSE 'some' END AS verdict FROM {_VALID} GROUP BY repo""")
def validity_by_group(spark: SparkSession, d: str) -> DataFrame:
    counted = catalog.validity(table(spark, d, "workflow_json"), ["repo"]).groupBy("repo").agg(F.count("*").alias("total"), F.count_if("valid").alias("valid"))
    return counted.withColumn("verdict", catalog.verdict(F.col("valid"), F.col("total")))


@query("""SELECT test, count(*) AS total, count(*) FILTER (WHERE ok) AS valid,
                 round(100.0 * count(*) FILTER (WHERE ok) / count(*), 4) AS rate FROM timing GROUP BY test""")
def success_rate(spark: SparkSession, d: str) -> DataFrame:
    return catalog.success_rate(table(spark, d, "timing"), ["test"], F.col("ok")).withColumn("rate", F.round("rate", 4))


@query("""SELECT run_id, elapsed_ms, CASE WHEN elapsed_ms < 50 THEN 'excellent' WHEN elapsed_ms < 100 THEN 'good'
                 WHEN elapsed_ms IS NOT NULL THEN 'slow' END AS grade FROM timing""")
def grade_latency(spark: SparkSession, d: str) -> DataFrame:
    grade = catalog.grade(F.col("elapsed_ms"), [(50.0, "excellent"), (100.0, "good")], "slow")
    return table(spark, d, "timing").select("run_id", "elapsed_ms", grade.alias("grade"))


@query("""SELECT test, round(avg(elapsed_ms) FILTER (WHERE ok), 4) AS avg_ok, round(avg(elapsed_ms), 4) AS avg_all FROM timing GROUP BY test""")
def average_latency(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "timing").groupBy("test")
    return rows.agg(F.round(F.avg(F.when(F.col("ok"), F.col("elapsed_ms"))), 4).alias("avg_ok"), F.round(F.avg("elapsed_ms"), 4).alias("avg_all"))


@query("""SELECT day, round(avg(v), 4) AS average FROM (SELECT run_at::DATE AS day, test, avg(elapsed_ms) AS v, coalesce(bool_or(ok), false) AS passed FROM timing
          WHERE test IN ('count', 'fulltext', 'filter') GROUP BY ALL) WHERE test <> 'fulltext' OR passed GROUP BY day
          UNION ALL SELECT day, NULL FROM (SELECT run_at::DATE AS day, bool_and(test = 'fulltext' AND NOT coalesce(ok, false)) AS none FROM timing
          WHERE test IN ('count', 'fulltext', 'filter') GROUP BY 1) WHERE none""")
def mean_of_passed(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "timing").withColumn("day", F.to_date("run_at"))
    return catalog.mean_of_passed(rows, ["day"], ["count", "filter"], ["fulltext"]).select("day", F.round("average", 4).alias("average"))


@query("""SELECT test, b AS before_n, a AS after_n, round((a - b) * 100.0 / nullif(b, 0), 4) AS change FROM (
          SELECT test, count(*) FILTER (WHERE run_at < TIMESTAMP '2024-04-01') AS b,
                 count(*) FILTER (WHERE run_at >= TIMESTAMP '2024-04-01') AS a FROM timing GROUP BY test)""")
def improvement_pct(spark: SparkSession, d: str) -> DataFrame:
    cut = F.lit("2024-04-01").cast("timestamp_ntz")
    rows = table(spark, d, "timing").groupBy("test")
    rows = rows.agg(F.count_if(F.col("run_at") < cut).alias("before_n"), F.count_if(F.col("run_at") >= cut).alias("after_n"))
    return rows.withColumn("change", F.round(catalog.improvement(F.col("before_n"), F.col("after_n")), 4))


_TYPES = "(SELECT file_id, coalesce(list_transform(nodes, lambda n: n.type), []) AS t FROM workflow_json)"


_BRANDS = " || ".join(f"CASE WHEN len(list_filter(t, lambda x: contains(lower(x), '{b}'))) > 0 THEN '{b},' ELSE '' END" for b in catalog.BRANDS)


@query(f"""SELECT file_id, n_nodes, n_triggers, n_nodes - n_triggers AS n_processing, handles_errors, n_types, rtrim(brands, ',') AS brands,
                  CASE WHEN n_nodes <= 5 THEN 'Simple' WHEN n_nodes <= 15 THEN 'Moderate' ELSE 'Complex' END AS complexity FROM (
           SELECT file_id, len(t)::INT AS n_nodes, len(list_filter(t, lambda x: regexp_matches(lower(x), 'trigger|webhook|cron')))::INT AS n_triggers,
                  len(list_filter(t, lambda x: regexp_matches(lower(x), 'stop(and|with)error|errortrigger'))) > 0 AS handles_errors,
                  (len(list_distinct(t)) + (len(list_filter(t, lambda x: x IS NULL)) > 0)::INT)::INT AS n_types, {_BRANDS} AS brands FROM {_TYPES})""")
def node_profile(spark: SparkSession, d: str) -> DataFrame:
    return catalog.node_profile(table(spark, d, "workflow_json"))


@query("""SELECT wf_id, filename, number, CASE WHEN len(rest) >= 2 THEN array_to_string(rest[:-3], '_') END AS services,
                 CASE WHEN len(rest) >= 2 THEN rest[-2] END AS action, CASE WHEN len(rest) >= 1 THEN rest[-1] END AS kind
          FROM (SELECT wf_id, filename, CASE WHEN numbered THEN parts[1]::BIGINT END AS number, CASE WHEN numbered THEN parts[2:] ELSE parts END AS rest
          FROM (SELECT *, regexp_matches(parts[1], '^[0-9]{1,18}$') AS numbered
          FROM (SELECT wf_id, filename, string_split(regexp_replace(filename, '\\.json$', ''), '_') AS parts FROM workflows WHERE filename IS NOT NULL)))""")
def filename_parts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "workflows").where(F.col("filename").isNotNull()).withColumn("p", text.filename_parts(F.col("filename")))
    return rows.select("wf_id", "filename", "p.number", "p.services", "p.action", "p.kind")


@query("""SELECT wf_id, CASE len(integrations) WHEN 1 THEN integrations[1] WHEN 2 THEN integrations[1] || ' and ' || integrations[2]
                 ELSE integrations[1] || ', ' || integrations[2] || ', and ' || integrations[3] END AS services
          FROM workflows WHERE len(integrations) > 0""")
def join_services(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "workflows").where(F.size("integrations") > 0)
    return rows.select("wf_id", text.join_with_and(F.col("integrations")).alias("services"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, date_trunc('week', ts)::DATE AS week, (ts::DATE + 7) AS next_week,
                 dayofweek(ts)::INT AS weekday, date_diff('day', DATE '2024-01-01', ts::DATE)::INT AS days FROM events""")
def date_ops(spark: SparkSession, d: str) -> DataFrame:
    day = F.to_date("ts")
    return table(spark, d, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_trunc("week", "ts").cast("date").alias("week"),
        F.date_add(day, 7).alias("next_week"),
        (F.dayofweek("ts") - 1).alias("weekday"),
        F.datediff(day, F.lit("2024-01-01").cast("date")).alias("days"),
    )


@query("SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, sha256(text) AS sha256 FROM documents")
def hash_ops(spark: SparkSession, d: str) -> DataFrame:
    kinds = ("md5", "sha1", "sha256")
    return table(spark, d, "documents").select("doc_id", *[codes.digest(F.col("text"), k).alias(k) for k in kinds])


@query(r"""SELECT doc_id, coalesce(source, '-') AS title, ['https://docs.example/' || doc_id] AS links,
                  array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g'), ' ')),
                                              lambda x: x <> ''), chr(10)) AS body FROM documents WHERE text IS NOT NULL""")
def html_extract(spark: SparkSession, d: str) -> DataFrame:
    """Every document's whole text, set as a page with marks and hidden parts, comes back from it."""
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(
        F.lit("<html><head><title>"), F.coalesce("source", F.lit("-")), F.lit("</title><style>p {}</style></head><body><script>x < y</script><p>"),
        escaped, F.lit("</p><a href='https://docs.example/"), F.col("doc_id"), F.lit("'></a></body>"),
    )
    return table(spark, d, "documents").where("text is not null").select("doc_id", text.html_extract(page).alias("p")).selectExpr("doc_id", "p.title", "p.links", "p.text AS body")


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def xml_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """From JSON to XML and back."""
    layout = "c_name string, c_acctbal double"
    rows = table(spark, d, "customer").select("c_custkey", F.to_json(F.struct("c_name", "c_acctbal")).alias("j"))
    rows = rows.select("c_custkey", text.xml_to_json(text.json_to_xml(F.col("j"), layout), layout).alias("j"))
    return rows.select("c_custkey", F.from_json("j", layout).alias("r")).select("c_custkey", "r.*")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity * -(l_linenumber + 0.5::DOUBLE) + l_suppkey) / 4 AS result, l_quantity / nullif(l_linenumber - 1, 0) AS divided FROM lineitem""")
def calculate(spark: SparkSession, d: str) -> DataFrame:
    """Arithmetic put together as text from the columns."""
    rows = table(spark, d, "lineitem")
    one = F.format_string("(%s * -(%s + 0.5) + %s) / 2^2", F.col("l_quantity").cast("string"), "l_linenumber", "l_suppkey")
    two = F.format_string("%s / (%s - 1)", F.col("l_quantity").cast("string"), "l_linenumber")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", arithmetic.calculate(one).alias("result"), arithmetic.calculate(two).alias("divided"))


_MASKED = "text"
for _pattern, _mark in text.MASKS:
    _MASKED = f"regexp_replace({_MASKED}, '{_pattern}', '{_mark.replace('$', chr(92))}', 'g')"


@query(f"SELECT doc_id, {_MASKED} AS masked FROM documents")
def mask_sensitive(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.mask_sensitive(F.col("text")).alias("masked"))


_URLS = """(SELECT file_id, k - 1 AS node_pos, n.parameters['url'] AS url FROM (SELECT file_id, unnest(nodes) AS n, generate_subscripts(nodes, 1) AS k FROM workflow_json))"""


_PART = r"CASE WHEN fine THEN nullif(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)(?:[?]([^#]*))?', {}), '') END"


@query(rf"""SELECT file_id, node_pos::INT AS node_pos, {_PART.format(1)} AS protocol, {_PART.format(2)} AS host, coalesce({_PART.format(3)}, CASE WHEN fine THEN '' END) AS path,
                   {_PART.format(4)} AS query FROM (SELECT *, regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') AND NOT regexp_matches(url, '[\s{{}}|\\^`<>"\[\]]') AS fine FROM {_URLS})
            WHERE url IS NOT NULL""")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "workflow_json").select("file_id", F.posexplode("nodes").alias("node_pos", "n"))
    rows = rows.select("file_id", "node_pos", F.col("n.parameters")["url"].alias("url")).where(F.col("url").isNotNull())
    return rows.withColumn("p", text.url_parts(F.col("url"))).select("file_id", "node_pos", "p.protocol", "p.host", "p.path", "p.query")


@query("""SELECT file_id, k::INT AS node_pos, CASE WHEN ltrim(m) LIKE '[%' THEN CASE WHEN json_valid(replace(m, chr(39), '"')) THEN
                 array_to_string(from_json(replace(m, chr(39), '"'), '["VARCHAR"]'), '+') END ELSE m END AS methods FROM (
          SELECT file_id, generate_subscripts(nodes, 1) - 1 AS k, unnest(nodes).parameters['method'] AS m FROM workflow_json) WHERE m IS NOT NULL""")
def webhook_methods(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "workflow_json").select("file_id", F.posexplode("nodes").alias("node_pos", "n"))
    rows = rows.select("file_id", "node_pos", F.col("n.parameters")["method"].alias("m")).where(F.col("m").isNotNull())
    return rows.select("file_id", "node_pos", F.array_join(text.parse_list_literal(F.col("m")), "+").alias("methods"))


_FACTORS = " ".join(f"WHEN '{u}' THEN {f!r}::DOUBLE" for u, (_, f) in codes.UNITS.items())
_KINDS = " ".join(f"WHEN '{u}' THEN '{k}'" for u, (k, _) in codes.UNITS.items())


@query(f"""SELECT s_suppkey, a, b, CASE WHEN CASE a {_KINDS} END = CASE b {_KINDS} END THEN s_acctbal * CASE a {_FACTORS} END / CASE b {_FACTORS} END END AS converted
           FROM supplier, (SELECT unnest({list(codes.UNITS)}) AS a), (SELECT unnest({list(codes.UNITS)}) AS b)""")
def convert_units(spark: SparkSession, d: str) -> DataFrame:
    """Every balance from every unit to every other; null between unlike quantities."""
    units = F.array(*map(F.lit, codes.UNITS))
    rows = table(spark, d, "supplier").select("s_suppkey", "s_acctbal", F.explode(units).alias("a")).withColumn("b", F.explode(units))
    return rows.select("s_suppkey", "a", "b", codes.convert_unit(F.col("s_acctbal"), F.col("a"), F.col("b")).alias("converted"))


@query("SELECT s_suppkey, s_name AS back FROM supplier")
def base64_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", codes.from_base64(codes.to_base64(F.col("s_name"))).alias("back"))


def _padded(key: bytes, mask: int) -> str:
    """A key of the keyed hash, filled up to a block of 64 bytes and masked, as a blob of SQL."""
    return "'" + "".join(f"\\x{b ^ mask:02x}" for b in key.ljust(64, b"\0")) + "'::BLOB"


_KEY = b"shared key"


@query(f"SELECT event_id, sha256({_padded(_KEY, 0x5C)} || unhex(sha256({_padded(_KEY, 0x36)} || encode(props)))) AS signature FROM events")
def hmac_sign(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", codes.hmac_hex(F.col("props"), _KEY).alias("signature"))
