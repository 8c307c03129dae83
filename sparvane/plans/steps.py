"""Queries of single steps: text helpers, own code, plug-ins, files, stores, indexing."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import code, digest, models, shape
from ..runtime import materialize, shared_dir, table
from ..sources import documents, files, stores
from .registry import query


def _folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:8]}"


@query("""SELECT wf_id, loaded_at, array_to_string(list_filter(list_transform(string_split(array_to_string(integrations, ' , '), ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS items
          FROM workflows WHERE integrations IS NOT NULL""")
def split_comma_list(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "workflows").where("integrations is not null")
    items = text.split_comma_list(F.array_join("integrations", " , "))
    return rows.select("wf_id", "loaded_at", F.array_join(items, "|").alias("items"))


@query(r"""SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(text, '\r?\n'), lambda x: trim(regexp_replace(x, '^[\s\x0b]*(?:[-*•]|[0-9]+[.)])[\s\x0b]+', ''), ' ')),
                  lambda x: x <> ''), chr(10)) AS items FROM documents WHERE text IS NOT NULL""")
def parse_items(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("text is not null")
    return rows.select("doc_id", F.array_join(text.parse_items(F.col("text")), "\n").alias("items"))


@query(r"""SELECT doc_id, k AS pos, array_to_string(w[k * 40 + 1 : k * 40 + 50], ' ') AS chunk FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 11, 0) // 40 + 1)) AS k FROM
           (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\s\x0b]+'), lambda x: x <> '') AS w FROM documents) WHERE len(w) > 0)""")
def chunk_words(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", text.chunk_words(F.col("text"), 50, 10).alias("c"))
    return rows.select("doc_id", F.posexplode("c").alias("pos", "chunk"))


@query("""SELECT doc_id, coalesce(regexp_matches(text, '(?i)slack'), NULL) AS named FROM documents""")
def brand_match(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.brand_match(F.col("text"), "slack").alias("named"))


@query("""SELECT file_id, k::INT AS node_pos, array_to_string(list_sort(list_transform(map_entries(p), lambda e: e.key || '=' || CASE WHEN e.key IN ('headers', 'password')
                 THEN '{{ $credentials.' || e.key || ' }}' ELSE coalesce(e.value, '~') END)), chr(10)) AS told
          FROM (SELECT file_id, generate_subscripts(nodes, 1) - 1 AS k, unnest(nodes).parameters AS p FROM workflow_json) WHERE p IS NOT NULL""")
def replace_credentials(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "workflow_json").select("file_id", F.posexplode("nodes").alias("node_pos", "n")).where("n.parameters is not null")
    entries = F.map_entries(text.replace_credentials(F.col("n.parameters"), ["headers", "password"]))
    told = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("~"))))
    return rows.select("file_id", "node_pos", F.array_join(F.array_sort(told), "\n").alias("told"))


@query("""SELECT wf_id, loaded_at, coalesce(name, '-') || CASE WHEN len(integrations) > 0 THEN ' that ' || CASE len(integrations) WHEN 1 THEN 'integrates with ' || integrations[1]
                 WHEN 2 THEN 'connects ' || integrations[1] || ' and ' || integrations[2]
                 ELSE 'orchestrates ' || integrations[1] || ', ' || integrations[2] || ', and ' || integrations[3] END || ' for reports' ELSE '' END || '. Uses ' || node_count || ' nodes' ||
                 CASE WHEN len(integrations) > 3 THEN ' and integrates with ' || len(integrations) || ' services' ELSE '' END || '.' AS sentence FROM workflows""")
def describe(spark: SparkSession, d: str) -> DataFrame:
    told = text.describe(F.coalesce("name", F.lit("-")), F.col("integrations"), F.lit("for reports"), F.col("node_count"))
    return table(spark, d, "workflows").select("wf_id", "loaded_at", told.alias("sentence"))


@query("SELECT run_id, test, elapsed_ms FROM timing")
def stop_on(spark: SparkSession, d: str) -> DataFrame:
    """Rows go on as none of them is wrong; a test has one that is."""
    return shape.stop_on(table(spark, d, "timing"), F.col("elapsed_ms") < 0, "a time below 0").select("run_id", "test", "elapsed_ms")


_PLACES = " ".join(f"WHEN '{c}' THEN {k}" for k, c in enumerate(digest.CATEGORIES, 1))


@query(f"SELECT category, CASE category {_PLACES} ELSE {len(digest.CATEGORIES) + 1} END AS place FROM (SELECT unnest({[*digest.CATEGORIES, 'other']}) AS category)")
def priority(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([(c,) for c in (*digest.CATEGORIES, "other")], "category string")
    return rows.select("category", digest.priority(F.col("category")).alias("place"))


@query("""SELECT lang, source, count(*) AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY ALL""")
def nested_map(spark: SparkSession, d: str) -> DataFrame:
    """Category to company to records, and flat again."""
    rows = table(spark, d, "documents").where("lang is not null and source is not null").selectExpr("lang AS category", "source AS company", "doc_id")
    flat = digest.digest_map(rows, ["doc_id"], ["doc_id"]).select(F.col("category").alias("lang"), F.explode("companies").alias("source", "r"))
    return flat.select("lang", "source", F.size("r").cast("long").alias("n"), F.array_join(F.transform("r", lambda x: x["doc_id"].cast("string")), ",").alias("ids"))


@query("""SELECT doc_id, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents WHERE text IS NOT NULL)""")
def one_to_many(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    pairs = code.one_to_many(rows, "text", lambda t: [{"pos": k, "word": w} for k, w in enumerate(t.split(" "))], "struct<pos:long,word:string>")
    return pairs.select("doc_id", "item.pos", "item.word")


@query("SELECT event_id, value * 3 + length(event_type) AS scored FROM events")
def over_items(spark: SparkSession, d: str) -> DataFrame:
    def score(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"event_id": batch["event_id"], "scored": batch["value"] * 3 + batch["event_type"].str.len()})

    return code.over_items(table(spark, d, "events").select("event_id", "event_type", "value"), score, "event_id long, scored double")


@query("SELECT event_id, reverse(event_type) AS turned FROM events")
def per_item(spark: SparkSession, d: str) -> DataFrame:
    turn = code.per_item(lambda s: s.str[::-1], "string")
    return table(spark, d, "events").select("event_id", turn("event_type").alias("turned"))


@query("SELECT user_id, count(*) AS n, max(value) AS most FROM events GROUP BY user_id")
def per_group(spark: SparkSession, d: str) -> DataFrame:
    """Own code over groups that are small by their nature: a user's events."""
    def figures(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"user_id": [group["user_id"].iloc[0]], "n": [len(group)], "most": [group["value"].max()]})

    return code.per_group(table(spark, d, "events").select("user_id", "value"), ["user_id"], figures, "user_id long, n long, most double")


@query("""SELECT wf_id, string_agg(substr(text, 1, 12), '|' ORDER BY doc_id) AS summary FROM documents WHERE wf_id IS NOT NULL AND text IS NOT NULL GROUP BY wf_id""")
def map_reduce_text(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("wf_id is not null").select("wf_id", "doc_id", "text")
    return code.map_reduce_text(rows, ["wf_id"], "doc_id", "text", lambda t: t[:12], "|".join)


@query("SELECT event_id, value * 2 AS value FROM events WHERE event_type = 'purchase'")
def call_workflow(spark: SparkSession, d: str) -> DataFrame:
    """A workflow that calls another."""
    code.workflow("sparvane-doubled")(lambda rows: rows.select("event_id", (F.col("value") * 2).alias("value")))
    code.workflow("sparvane-purchases")(lambda rows: code.call_workflow("sparvane-doubled", rows.where("event_type = 'purchase'")))
    return code.call_workflow("sparvane-purchases", table(spark, d, "events"))


@query("""SELECT doc_id, length(text) AS n, CASE WHEN length(text) > 400 THEN 'long' WHEN text IS NOT NULL THEN 'short' END AS label FROM documents""")
def model_steps(spark: SparkSession, d: str) -> DataFrame:
    """Extraction and classification by a stand-in for a model that measures the text it is given."""
    def measure(prompts: list[str]) -> list[str]:
        return [f"Here it is:\n```json\n{{'n': {len(p.split(chr(10), 1)[1])},}}\n```" for p in prompts]

    def judge(prompts: list[str]) -> list[str]:
        return ["Long" if len(p.split("\n", 1)[1]) > 400 else "short" for p in prompts]

    rows = models.extract_fields(table(spark, d, "documents").select("doc_id", "text"), "text", {"n": "bigint"}, measure)
    return models.classify_by_model(rows, "text", ["long", "short"], judge).select("doc_id", "extracted.n", "label")


@query("""SELECT doc_id, text FROM documents WHERE text IS NOT NULL""")
def load_documents(spark: SparkSession, d: str) -> DataFrame:
    """Every text as a file held in binary, loaded again."""
    rows = table(spark, d, "documents").where("text is not null")
    held = rows.select(F.concat(F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), F.col("text").cast("binary").alias("content"))
    return documents.documents_of(held).select(F.split_part("source", F.lit("."), F.lit(1)).cast("long").alias("doc_id"), "text")


_KINDS = {"csv": {"compression": "gzip"}, "json": {"compression": "bzip2"}, "orc": {"compression": "zlib"}, "parquet": {"compression": "zstd"}, "xml": {"rowTag": "row"}}


@query(f"SELECT kind, c_custkey, c_name, c_acctbal FROM customer, (SELECT unnest({list(_KINDS)}) AS kind)")
def convert_formats(spark: SparkSession, d: str) -> DataFrame:
    """The customers through files of every format, compressed in several ways."""
    rows, layout, out = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), "c_custkey long, c_name string, c_acctbal double", None
    for kind, options in _KINDS.items():
        at = _folder(spark, f"files-{kind}")
        files.convert_to_file(rows, at, kind, **options)
        back = files.extract_from_file(spark, at, kind, layout, **options).select(F.lit(kind).alias("kind"), *rows.columns)
        out = back if out is None else out.union(back)
    return out


_BEFORE = "loaded_at < TIMESTAMP '2024-07-01'"


@query(f"""WITH f AS (SELECT path, body, CASE WHEN json_valid(body) THEN NULL ELSE 'broken' END AS error, bool_or({_BEFORE}) AS known FROM workflow_files GROUP BY path, body)
           SELECT count(*) FILTER (WHERE error IS NULL AND NOT coalesce(known, false)) AS processed, count(*) FILTER (WHERE error IS NULL AND known) AS skipped,
                  count(*) FILTER (WHERE error IS NOT NULL) AS errors, count(*) AS total FROM f""")
def index_files(spark: SparkSession, d: str) -> DataFrame:
    """Files indexed before a day are skipped if they are unchanged."""
    rows = table(spark, d, "workflow_files").withColumn("error", F.when(F.try_parse_json("body").isNull(), "broken"))
    rows = materialize(files.fingerprint(rows, ["path", "body"]).select(F.col("path").alias("filename"), "fingerprint", "error", "loaded_at"), "index-files")
    known = rows.where(f"{_BEFORE.replace('TIMESTAMP', 'TIMESTAMP_NTZ')} and error is null").select("filename", "fingerprint")
    now = rows.select("filename", "fingerprint", "error").distinct()
    return files.index_files(now, known)[1].select(*[F.col(c).cast("long").alias(c) for c in ("processed", "skipped", "errors", "total")])


_CUT = "loaded_at >= TIMESTAMP '2024-07-01'"


@query(f"""SELECT wf_id::VARCHAR AS key, coalesce(max(name) FILTER (WHERE {_CUT}), max(name) FILTER (WHERE NOT {_CUT})) AS value, bool_or({_CUT}) AS again FROM workflows
           WHERE name IS NOT NULL GROUP BY wf_id""")
def key_value_store(spark: SparkSession, d: str) -> DataFrame:
    """Names put in two deliveries; the later one counts."""
    rows = table(spark, d, "workflows").where("name is not null").withColumn("second", F.expr(_CUT.replace("TIMESTAMP", "TIMESTAMP_NTZ")))
    store = stores.KeyValueStore(spark, _folder(spark, "store"))
    for second in (False, True):
        store.put(rows.where(F.col("second") == second).select(F.col("wf_id").cast("string").alias("key"), F.col("name").alias("value")))
    again = rows.groupBy(F.col("wf_id").cast("string").alias("key")).agg(F.max("second").alias("again"))
    return store.get().join(again, "key")


@query(f"""WITH a AS (SELECT wf_id, max(name) AS name, count(*) AS n FROM workflows WHERE NOT {_CUT} GROUP BY wf_id), b AS (SELECT wf_id, max(name) AS name, count(*) AS n FROM workflows GROUP BY wf_id)
           SELECT wf_id, CASE WHEN a.n IS NULL THEN 'insert' ELSE 'update' END AS action, a.name AS old_name, b.name AS new_name, a.n AS old_n, b.n AS new_n
           FROM b LEFT JOIN a USING (wf_id) WHERE a.n IS NULL OR a.n <> b.n OR a.name IS DISTINCT FROM b.name""")
def change_feed(spark: SparkSession, d: str) -> DataFrame:
    """What the second poll of a table finds changed since the first."""
    rows = table(spark, d, "workflows")
    feed = stores.SnapshotFeed(spark, _folder(spark, "feed"))
    polls = (rows.where(~F.expr(_CUT.replace("TIMESTAMP", "TIMESTAMP_NTZ"))), rows)
    first, second = (feed.poll(r.groupBy("wf_id").agg(F.max("name").alias("name"), F.count("*").alias("n")), ["wf_id"]) for r in polls)
    return second
