"""Queries of the general operators for training data: schema drift, nested records, skewed keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift, flatten, skew
from ..runtime import table
from .registry import query


_DRIFT = """WITH b AS (SELECT DISTINCT raw_id, body::JSON AS j FROM workflow_files WHERE CASE WHEN json_valid(body) THEN json_type(body) = 'OBJECT' ELSE false END),
          o AS (SELECT raw_id, 'file' AS level, j FROM b
                UNION ALL SELECT raw_id, 'node', n.value FROM b, json_each(j, '$.nodes') n WHERE json_type(j, '$.nodes') = 'ARRAY' AND n.type = 'OBJECT'
                UNION ALL SELECT raw_id, 'link', l.value FROM b, json_each(j, '$.connections') s, json_each(s.value) p, json_each(p.value) t, json_each(t.value) l
                WHERE json_type(j, '$.connections') = 'OBJECT' AND s.type = 'OBJECT' AND p.type = 'ARRAY' AND t.type = 'ARRAY' AND l.type = 'OBJECT'),
          n AS (SELECT *, row_number() OVER () AS k FROM o),
          f AS (SELECT k, raw_id, level, e.key AS field, CASE e.type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array'
                       WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN 'null' ELSE 'number' END AS t FROM n, json_each(n.j) e),
          missing AS (SELECT k, raw_id, level, field, json_type AS t, row_number() OVER (PARTITION BY k, json_type ORDER BY field) AS i
                      FROM (SELECT k, raw_id, n.level, field, json_type FROM n JOIN schema_fields s ON s.level = n.level AND s.required) m ANTI JOIN f USING (k, field)),
          unknown AS (SELECT k, raw_id, level, field, t, row_number() OVER (PARTITION BY k, t ORDER BY field) AS i FROM f ANTI JOIN schema_fields s USING (level, field)),
          c AS (SELECT raw_id, level, field, CASE WHEN u.k IS NULL THEN 'removed' ELSE 'renamed' END AS change, u.name AS detail
                FROM missing m LEFT JOIN (SELECT k, t, i, field AS name FROM unknown) u USING (k, t, i)
                UNION SELECT raw_id, level, field, 'added', t FROM unknown ANTI JOIN missing USING (k, t, i)
                UNION SELECT raw_id, level, field, 'retyped', t FROM f JOIN schema_fields s USING (level, field) WHERE t <> 'null' AND t <> json_type)"""


@query(f"{_DRIFT} SELECT DISTINCT raw_id, level, field, change FROM c")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drift.changes(table(spark, sf_dir, "workflow_files"), table(spark, sf_dir, "schema_fields"))
    return found.select("raw_id", "level", "field", "change").distinct()


@query()
def p4_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.uniform(table(spark, sf_dir, "workflow_files"), table(spark, sf_dir, "schema_fields"))


@query(f"""{_DRIFT} SELECT level, field, change, detail, min(exported_at) AS first_seen, max(exported_at) AS last_seen, count(DISTINCT raw_id) AS n_files
           FROM c JOIN (SELECT raw_id, min(exported_at) AS exported_at FROM workflow_files GROUP BY raw_id) USING (raw_id) GROUP BY ALL""")
def p4_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.change_log(table(spark, sf_dir, "workflow_files"), table(spark, sf_dir, "schema_fields"))


@query(f"""{_DRIFT} SELECT level, field, CASE WHEN count(DISTINCT t) FILTER (WHERE t <> 'null') <= 1 THEN coalesce(max(t) FILTER (WHERE t <> 'null'), 'null')
                  WHEN count(*) FILTER (WHERE t NOT IN ('null', 'boolean', 'number')) = 0 THEN 'number' ELSE 'string' END AS json_type,
                  count(*) AS n_objects, coalesce(bool_or(known), false) AS agreed FROM f LEFT JOIN (SELECT level, field, true AS known FROM schema_fields) s USING (level, field) GROUP BY ALL""")
def p4_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = drift.Layout.read(table(spark, sf_dir, "schema_fields"))
    return drift.union_schema(table(spark, sf_dir, "workflow_files"), layout)


@query("""WITH f AS (SELECT file_id, nodes, CASE WHEN json_valid(connections) THEN CASE WHEN json_type(connections) = 'OBJECT' THEN connections::JSON END END AS c
                     FROM workflow_json WHERE len(nodes) > 0),
          x AS (SELECT file_id, unnest(nodes) AS n FROM f), names AS (SELECT DISTINCT file_id, n.name AS name FROM x),
          links AS (SELECT f.file_id, s.key AS parent, TRY_CAST(t.key AS INT) AS slot, l.value->>'$.node' AS child
                    FROM f, json_each(f.c) s, json_each(s.value) p, json_each(p.value) t, json_each(t.value) l
                    WHERE s.type = 'OBJECT' AND p.type = 'ARRAY' AND t.type = 'ARRAY' AND l.type = 'OBJECT' AND json_type(l.value, '$.node') = 'VARCHAR'),
          r AS (SELECT file_id, n.name AS name, CASE WHEN json_valid(n.parameters['rules']) THEN n.parameters['rules']::JSON END AS j FROM x),
          v AS (SELECT file_id, name, TRY_CAST(u.key AS INT) AS slot, u.value AS value, u.value->>'$.id' AS id FROM r, json_each(r.j, '$.values') u
                WHERE json_type(r.j, '$.values') = 'ARRAY' AND u.type = 'OBJECT' AND json_type(u.value, '$.id') = 'VARCHAR'),
          i AS (SELECT file_id, v.id AS parent, TRY_CAST(w.key AS INT) AS slot, w.value->>'$.id' AS child FROM v, json_each(v.value, '$.conditions.items') w
                WHERE json_type(v.value, '$.conditions.items') = 'ARRAY' AND w.type = 'OBJECT' AND json_type(w.value, '$.id') = 'VARCHAR')
          SELECT DISTINCT file_id, 'link' AS kind, parent, slot, child FROM links l
          SEMI JOIN names a ON a.file_id = l.file_id AND a.name = l.parent SEMI JOIN names b ON b.file_id = l.file_id AND b.name = l.child
          UNION SELECT file_id, 'rule', name, slot, id FROM v UNION SELECT file_id, 'condition', parent, slot, child FROM i""")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.flatten(table(spark, sf_dir, "workflow_json"))


@query("""SELECT file_id, (k - 1)::INT AS node_pos, n.id AS id, n.name AS name, n.type AS type, n.type_version AS type_version,
                 coalesce(cardinality(n.parameters), 0)::INT AS n_parameters
          FROM (SELECT file_id, unnest(nodes) AS n, generate_subscripts(nodes, 1) AS k FROM workflow_json)""")
def p6_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.node_table(table(spark, sf_dir, "workflow_json"))


_KEYS = ("trigger_type", "category")


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS field, {c} AS key_value FROM workflows WHERE {c} IS NOT NULL
            GROUP BY {c} HAVING count(*) >= 0.05 * (SELECT count(*) FROM workflows)"""
        for c in _KEYS
    )
)
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.frequent_values_of(table(spark, sf_dir, "workflows"), list(_KEYS)).select("field", "key_value")


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS field, {c} AS key_value, count(*) AS n_rows, count(DISTINCT wf_id) AS n_ids,
                   count(*) FILTER (WHERE active) AS n_flagged, avg(node_count) AS avg_measure FROM workflows GROUP BY {c}"""
        for c in _KEYS
    )
)
def p7_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "workflows")
    heavy, _ = skew.heavy_keys_of(rows, list(_KEYS))
    one, two = (skew.per_key(rows, c, "wf_id", "active", "node_count", heavy=k).withColumn("field", F.lit(c)) for c, k in zip(_KEYS, heavy))
    return one.union(two).select("field", "key_value", "n_rows", "n_ids", "n_flagged", "avg_measure")
