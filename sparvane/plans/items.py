"""Queries of the item-stream operators: merging, shaping, ordering, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import relational as r
from ..operators import shape
from ..runtime import table
from .registry import query


@query("""SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
          UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def merge_append(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_mktsegment AS segment")
    return r.merge_append(a, table(spark, d, "supplier").selectExpr("s_suppkey AS key", "s_name AS name"))


def _files(spark, d):
    return table(spark, d, "workflow_json").selectExpr("wf_id AS key", "file_id", "name")


def _rows(spark, d):
    return table(spark, d, "workflows").selectExpr("wf_id AS key", "name", "category", "loaded_at")


#: Files of workflows, of which many have none and several may share one, and catalog rows, some of them delivered twice.
_FILES = "(SELECT wf_id AS key, file_id, name FROM workflow_json) a"
_ROWS = "(SELECT wf_id AS key, name AS name_right, category, loaded_at FROM workflows) b"
_BOTH = "key, file_id, name, name_right, category, loaded_at"


@query(f"SELECT {_BOTH} FROM {_FILES} JOIN {_ROWS} USING (key)")
def merge_inner(spark: SparkSession, d: str) -> DataFrame:
    return r.merge_by_key(_files(spark, d), _rows(spark, d), ["key"])


@query(f"SELECT {_BOTH} FROM {_FILES} LEFT JOIN {_ROWS} USING (key)")
def merge_left(spark: SparkSession, d: str) -> DataFrame:
    return r.merge_by_key(_files(spark, d), _rows(spark, d), ["key"], "left")


@query(f"SELECT {_BOTH} FROM {_FILES} RIGHT JOIN {_ROWS} USING (key)")
def merge_right(spark: SparkSession, d: str) -> DataFrame:
    return r.merge_by_key(_files(spark, d), _rows(spark, d), ["key"], "right")


@query(f"SELECT {_BOTH} FROM {_FILES} FULL JOIN {_ROWS} USING (key)")
def merge_full(spark: SparkSession, d: str) -> DataFrame:
    return r.merge_by_key(_files(spark, d), _rows(spark, d), ["key"], "full_outer")


@query(f"SELECT key, file_id, name FROM {_FILES} SEMI JOIN {_ROWS} USING (key)")
def merge_semi(spark: SparkSession, d: str) -> DataFrame:
    return r.merge_by_key(_files(spark, d), _rows(spark, d), ["key"], "left_semi")


@query(f"SELECT key, name_right AS name, category, loaded_at FROM {_ROWS} ANTI JOIN {_FILES} USING (key)")
def merge_anti(spark: SparkSession, d: str) -> DataFrame:
    return r.merge_by_key(_rows(spark, d), _files(spark, d), ["key"], "left_anti")


@query("""SELECT * FROM (SELECT row_number() OVER (ORDER BY s_name, s_suppkey) - 1 AS position, * FROM supplier) JOIN
          (SELECT row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1 AS position, * FROM part) USING (position)""")
def merge_position(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "supplier"), table(spark, d, "part")
    return r.merge_by_position(a, b, [F.col("s_name"), F.col("s_suppkey")], [F.desc("p_retailprice"), F.col("p_partkey")])


@query("SELECT n_name, r_name FROM nation CROSS JOIN region")
def merge_cross(spark: SparkSession, d: str) -> DataFrame:
    return r.merge_all_combinations(table(spark, d, "nation"), table(spark, d, "region")).select("n_name", "r_name")


@query("SELECT s_suppkey, r_name FROM supplier JOIN region ON s_acctbal > r_regionkey * 2000")
def theta_join(spark: SparkSession, d: str) -> DataFrame:
    joined = r.merge_all_combinations(table(spark, d, "supplier"), table(spark, d, "region"), F.expr("s_acctbal > r_regionkey * 2000"))
    return joined.select("s_suppkey", "r_name")


#: Titles per workflow as its files and as the catalog have them.
_A = "(SELECT wf_id AS key, min(name) AS title, count(*) AS n FROM workflow_json WHERE wf_id IS NOT NULL GROUP BY wf_id)"
_B = "(SELECT wf_id AS key, min(name) AS title, count(*) AS n FROM workflows GROUP BY wf_id)"


def _two(spark, d):
    both = (table(spark, d, "workflow_json").where("wf_id is not null"), table(spark, d, "workflows"))
    return [t.groupBy(F.col("wf_id").alias("key")).agg(F.min("name").alias("title"), F.count("*").alias("n")) for t in both]


_FULL = f"""(SELECT key, k IS NOT NULL AS in_a, l IS NOT NULL AS in_b, a_title, b_title, a_n, b_n, a_title IS NOT DISTINCT FROM b_title AND a_n = b_n AS same
            FROM (SELECT key, key AS k, title AS a_title, n AS a_n FROM {_A}) FULL JOIN (SELECT key, key AS l, title AS b_title, n AS b_n FROM {_B}) USING (key))"""


@query(f"""SELECT key, CASE WHEN NOT in_b THEN 'only_a' WHEN NOT in_a THEN 'only_b' WHEN same THEN 'same' ELSE 'different' END AS status,
                  a_title, b_title, a_n, b_n FROM {_FULL}""")
def compare_datasets(spark: SparkSession, d: str) -> DataFrame:
    return r.compare_datasets(*_two(spark, d), ["key"])


@query(f"SELECT key, CASE WHEN NOT in_b THEN 'insert' WHEN NOT in_a THEN 'delete' ELSE 'update' END AS action FROM {_FULL} WHERE NOT (in_a AND in_b AND same)")
def sync_plan(spark: SparkSession, d: str) -> DataFrame:
    return r.sync_plan(*_two(spark, d), ["key"])


@query(f"SELECT key, coalesce(a.title, b.title) AS title, b.n AS n FROM {_B} b LEFT JOIN {_A} a USING (key)")
def prefer_existing(spark: SparkSession, d: str) -> DataFrame:
    a, b = _two(spark, d)
    return r.prefer_existing(b, a, ["key"], "title")


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def remove_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return r.remove_duplicates(table(spark, d, "lineitem").select("l_partkey", "l_suppkey"), ["l_partkey", "l_suppkey"])


@query("SELECT wf_id FROM workflows EXCEPT SELECT wf_id FROM workflow_json")
def set_difference(spark: SparkSession, d: str) -> DataFrame:
    return r.difference(table(spark, d, "workflows").select("wf_id"), table(spark, d, "workflow_json").select("wf_id"))


@query("SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersection(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "customer").selectExpr("c_nationkey AS nation")
    return r.intersection(a, table(spark, d, "supplier").selectExpr("s_nationkey AS nation"))


@query("SELECT c_nationkey AS nation FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def set_difference_all(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "customer").selectExpr("c_nationkey AS nation")
    return r.difference(a, table(spark, d, "supplier").selectExpr("s_nationkey AS nation"), keep_all=True)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, bracket FROM lineitem JOIN
          (SELECT p_size AS bracket, p_size * 10 AS low, p_size * 10 + 15 AS high FROM (SELECT DISTINCT p_size FROM part))
          ON l_suppkey >= low AND l_suppkey < high""")
def range_join(spark: SparkSession, d: str) -> DataFrame:
    ranges = table(spark, d, "part").select("p_size").distinct().selectExpr("p_size AS bracket", "p_size * 10 AS low", "p_size * 10 + 15 AS high")
    joined = r.range_join(table(spark, d, "lineitem"), ranges, "l_suppkey", "low", "high", 16)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "bracket")


@query("""SELECT e.event_id, e.user_id, p.event_id AS last_purchase FROM (SELECT * FROM events WHERE event_type = 'click') e
          ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts >= p.ts""")
def asof_join(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events")
    left = rows.where("event_type = 'click'").select("event_id", "user_id", "ts")
    right = rows.where("event_type = 'purchase'").selectExpr("event_id AS last_purchase", "user_id", "ts")
    return r.asof_join(left, right, ["user_id"], "ts", ["last_purchase"]).select("event_id", "user_id", "last_purchase")


@query("SELECT wf_id, generate_subscripts(integrations, 1)::INT - 1 AS pos, unnest(integrations) AS integration FROM workflows")
def split_out(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "workflows").selectExpr("wf_id", "integrations AS integration")
    return shape.split_out(rows, "integration", position="pos")


@query("SELECT wf_id, unnest(CASE WHEN len(integrations) > 0 THEN integrations ELSE [NULL] END) AS integration FROM workflows")
def split_out_keep(spark: SparkSession, d: str) -> DataFrame:
    return shape.split_out(table(spark, d, "workflows").selectExpr("wf_id", "integrations AS integration"), "integration", keep_empty=True)


@query("SELECT n_regionkey, string_agg(n_name, '|' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def aggregate_items(spark: SparkSession, d: str) -> DataFrame:
    gathered = shape.aggregate_items(table(spark, d, "nation"), "n_name", ["n_regionkey"])
    return gathered.select("n_regionkey", F.array_join("items", "|").alias("names"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty, round(avg(l_extendedprice), 2) AS avg_price,
                 min(l_discount) AS min_discount, max(l_tax) AS max_tax FROM lineitem GROUP BY ALL""")
def summarize(spark: SparkSession, d: str) -> DataFrame:
    wanted = [("count", "l_orderkey", "n"), ("sum", "l_quantity", "sum_qty"), ("average", "l_extendedprice", "avg_price"),
              ("min", "l_discount", "min_discount"), ("max", "l_tax", "max_tax")]
    out = shape.summarize(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], wanted)
    return out.withColumns({c: F.round(c, 2) for c in ("sum_qty", "avg_price")})


@query("""SELECT c_mktsegment, count(DISTINCT c_nationkey) AS nations, string_agg(c_nationkey::VARCHAR, ',' ORDER BY c_nationkey::VARCHAR) AS listed
          FROM customer GROUP BY 1""")
def summarize_distinct(spark: SparkSession, d: str) -> DataFrame:
    wanted = [("count_unique", "c_nationkey", "nations"), ("concatenate", "c_nationkey", "listed")]
    return shape.summarize(table(spark, d, "customer"), ["c_mktsegment"], wanted)


@query("SELECT wf_id, active, CASE WHEN active THEN 'true' ELSE 'false' END AS branch FROM workflows")
def if_branch(spark: SparkSession, d: str) -> DataFrame:
    yes, no = shape.if_branch(table(spark, d, "workflows").select("wf_id", "active"), F.col("active"))
    return yes.withColumn("branch", F.lit("true")).union(no.withColumn("branch", F.lit("false")))


@query("""SELECT event_id, CASE WHEN value > 100 THEN 'large' WHEN event_type = 'error' THEN 'error' ELSE 'rest' END AS route FROM events""")
def switch_route(spark: SparkSession, d: str) -> DataFrame:
    rules = [("large", F.col("value") > 100), ("error", F.col("event_type") == "error")]
    return shape.switch_route(table(spark, d, "events").select("event_id", "value", "event_type"), rules, "rest").select("event_id", "route")


@query("SELECT event_id, value * 2 AS doubled, upper(event_type) AS kind FROM events")
def set_fields(spark: SparkSession, d: str) -> DataFrame:
    fields = {"event_id": F.col("event_id"), "doubled": F.col("value") * 2, "kind": F.upper("event_type")}
    return shape.set_fields(table(spark, d, "events"), fields, keep_only=True)


@query("SELECT r_regionkey AS id, r_name AS label FROM region")
def rename_keys(spark: SparkSession, d: str) -> DataFrame:
    return shape.rename_keys(table(spark, d, "region"), {"r_regionkey": "id", "r_name": "label"})


@query("SELECT * FROM events ORDER BY ts, event_id LIMIT 25")
def limit_first(spark: SparkSession, d: str) -> DataFrame:
    return shape.limit_items(table(spark, d, "events"), 25, [("ts", True), ("event_id", True)])


@query("SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 25")
def limit_last(spark: SparkSession, d: str) -> DataFrame:
    return shape.limit_items(table(spark, d, "events"), 25, [("ts", True), ("event_id", True)], last=True)


@query("""SELECT wf_id, category, node_count, loaded_at FROM workflows""")
def sort_multi(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "workflows").select("wf_id", "category", "node_count", "loaded_at")
    return shape.sort_items(rows, ("category", True), ("node_count", False), ("wf_id", True), ("loaded_at", True))


@query("SELECT *, ((row_number() OVER (ORDER BY ts, event_id) - 1) // 100)::BIGINT AS batch FROM events")
def split_in_batches(spark: SparkSession, d: str) -> DataFrame:
    return shape.split_in_batches(table(spark, d, "events"), 100, [F.col("ts"), F.col("event_id")])


@query("""SELECT p_partkey, 'p_size' AS variable, p_size::DOUBLE AS value FROM part
          UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""")
def unpivot(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return shape.unpivot(rows, ["p_partkey"], ["p_size", "p_retailprice"])


_NATIONS = range(25)  # the whole of the nation table


@query("SELECT c_mktsegment, " + ", ".join(f"count(*) FILTER (WHERE c_nationkey = {k}) AS n{k}" for k in _NATIONS) + " FROM customer GROUP BY 1")
def pivot_counts(spark: SparkSession, d: str) -> DataFrame:
    return shape.pivot_counts(table(spark, d, "customer"), ["c_mktsegment"], "c_nationkey", list(_NATIONS), "n")


_GROUPED = """SELECT l_returnflag, l_linestatus, grouping(l_returnflag, l_linestatus)::BIGINT AS level, count(*) AS n
              FROM lineitem GROUP BY {} (l_returnflag, l_linestatus)"""


@query(_GROUPED.format("CUBE"))
def cube_counts(spark: SparkSession, d: str) -> DataFrame:
    return shape.grouped_counts(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "cube")


@query(_GROUPED.format("ROLLUP"))
def rollup_counts(spark: SparkSession, d: str) -> DataFrame:
    return shape.grouped_counts(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "rollup")


@query("""SELECT event_type, user_id, grouping(event_type, user_id)::BIGINT AS level, count(*) AS n FROM events GROUP BY GROUPING SETS ((event_type), (user_id), ())""")
def grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    return shape.grouped_counts(table(spark, d, "events"), ["event_type", "user_id"], [["event_type"], ["user_id"], []])


@query("""SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 5""")
def memory_window(spark: SparkSession, d: str) -> DataFrame:
    return shape.last_k(table(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 5).select("event_id", "user_id")


@query("""SELECT event_id, array_to_string(list(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), '>') AS path
          FROM events""")
def rolling_list(spark: SparkSession, d: str) -> DataFrame:
    rows = shape.rolling_list(table(spark, d, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], "event_type", 3)
    return rows.select("event_id", F.array_join("window", ">").alias("path"))


@query("""SELECT wf_id, repo, filename, name, category, trigger_type, node_count, last_indexed, loaded_at FROM (SELECT *, row_number() OVER (PARTITION BY wf_id
          ORDER BY loaded_at DESC NULLS LAST, last_indexed DESC NULLS LAST, filename, name) AS k FROM workflows) WHERE k = 1""")
def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    order = [F.desc_nulls_last("loaded_at"), F.desc_nulls_last("last_indexed"), F.asc_nulls_last("filename"), F.asc_nulls_last("name")]
    rows = table(spark, d, "workflows").select("wf_id", "repo", "filename", "name", "category", "trigger_type", "node_count", "last_indexed", "loaded_at")
    return r.remove_duplicates(rows, ["wf_id"], order)


@query("""SELECT repo, file_id FROM (SELECT repo, file_id, row_number() OVER (PARTITION BY repo ORDER BY file_id) AS n FROM workflow_json) WHERE n <= 2""")
def first_n_per_group(spark: SparkSession, d: str) -> DataFrame:
    return shape.first_n(table(spark, d, "workflow_json").select("repo", "file_id"), ["repo"], [F.col("file_id")], 2)


@query("""SELECT wf_id, loaded_at, CASE WHEN n > 1 AND name IS NOT NULL THEN concat_ws(' ', name, n) ELSE name END AS name FROM
          (SELECT wf_id, loaded_at, name, row_number() OVER (PARTITION BY name ORDER BY wf_id, loaded_at, last_indexed) AS n FROM workflows)""")
def dedupe_suffix(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "workflows").select("wf_id", "loaded_at", "name", "last_indexed")
    order = [F.col(c).asc_nulls_last() for c in ("wf_id", "loaded_at", "last_indexed")]
    return shape.dedupe_suffix(rows, "name", order).select("wf_id", "loaded_at", "name")


@query("""SELECT file_id, repo, name, connections, updated_at, row_number() OVER (ORDER BY updated_at DESC, file_id DESC) <= 10 AS keep FROM workflow_json""")
def retention_top_n(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "workflow_json").select("file_id", "repo", "name", "connections", "updated_at")
    return shape.keep_newest(rows, 10, [F.desc_nulls_last("updated_at"), F.desc("file_id")])


@query("""SELECT event_id, lag(value) OVER w AS previous, lead(event_type, 2) OVER w AS after_next, rank() OVER v AS rank, dense_rank() OVER v AS dense_rank,
                 ntile(4) OVER w AS quarter, first(event_type) OVER w AS opened_with, last(event_type) OVER u AS closed_with, nth_value(event_id, 2) OVER u AS second,
                 count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS in_a_day FROM events
          WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id), v AS (PARTITION BY user_id ORDER BY event_type),
                 u AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def window_functions(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    w, by_type = Window.partitionBy("user_id").orderBy("ts", "event_id"), Window.partitionBy("user_id").orderBy("event_type")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    columns = {
        "previous": F.lag("value").over(w), "after_next": F.lead("event_type", 2).over(w), "rank": F.rank().over(by_type), "dense_rank": F.dense_rank().over(by_type),
        "quarter": F.ntile(4).over(w), "opened_with": F.first("event_type").over(w), "closed_with": F.last("event_type").over(whole),
        "second": F.nth_value("event_id", 2).over(whole),
        "in_a_day": F.expr("count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '1' DAY PRECEDING AND CURRENT ROW)"),
    }
    return table(spark, d, "events").withColumns(columns).select("event_id", *columns)
