"""The queries of this package, by name; ``__spark_entry__.py`` adds them if the package is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import materialize, table
from . import bpe, cooccur, copies, neardup, packing, secrets, spans


def p1_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger(spark, sf_dir).counts().select("field", "n", "keep_id")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger(spark, sf_dir).copies()


def _ledger(spark, sf_dir):
    files = copies.file_keys(table(spark, sf_dir, "workflow_json")).withColumn("loaded_at", F.lit(None).cast("timestamp_ntz"))
    rows = table(spark, sf_dir, "workflows")
    names = copies.name_keys(rows, keep=("loaded_at",))
    members = materialize(files.union(names), "copy-members")  # the keys are made once, and are short
    return copies.absorb_deliveries(copies.CopyLedger(spark), members)


def _near(spark, sf_dir):
    return neardup.NearDuplicates(neardup.workflow_sources(table(spark, sf_dir, "workflow_json"), table(spark, sf_dir, "workflows")))


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near(spark, sf_dir).groups()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near(spark, sf_dir).pairs()


def p3_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccur.scored_pairs(cooccur.node_type_baskets(table(spark, sf_dir, "workflow_json")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    often = (F.col("n_ab") >= 5) & (F.col("n_ab") * 50 >= F.col("n_records"))
    above = F.col("n_ab") * F.col("n_records") * 2 >= F.col("n_a") * F.col("n_b") * 5
    return p3_pairs(spark, sf_dir).where(often & above).select("type_a", "type_b")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(secrets.parameters(table(spark, sf_dir, "workflow_json")))
    return found.select("file_id", "node_pos", "param").distinct()


def p5_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.redact_files(table(spark, sf_dir, "workflow_json"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_corpus(table(spark, sf_dir, "documents"))


def p9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    sized = documents.select("doc_id", bpe.count_tokens(F.col("text"), bpe.compiled(spark)).alias("n_tokens"))
    return packing.pack_containers(sized, table(spark, sf_dir, "containers"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.SharedSpans(table(spark, sf_dir, "documents")).pairs()


def p10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return spans.SharedSpans(documents).shares(documents)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_counts, p1_found, p2_groups, p2_found, p3_pairs, p3_found, p5_found, p5_redacted, p8_ids, p9_pack, p10_found, p10_shares)}


def oracle_sql() -> dict[str, str]:
    """DuckDB's equivalents, where SQL can express the query on whole tables."""
    files = "(SELECT file_id, nodes FROM workflow_json WHERE len(nodes) > 0)"
    items = f"(SELECT DISTINCT file_id, n.type AS item FROM (SELECT file_id, unnest(nodes) AS n FROM {files}) WHERE n.type IS NOT NULL)"
    pairs = f"""
        WITH i AS MATERIALIZED {items}, n AS (SELECT item, count(*) AS n FROM i GROUP BY item),
        t AS (SELECT count(*) AS n_records FROM {files}),
        p AS (SELECT a.item AS type_a, b.item AS type_b, count(*) AS n_ab FROM i a JOIN i b USING (file_id)
              WHERE a.item < b.item GROUP BY 1, 2),
        s AS (SELECT type_a, type_b, n_ab, x.n AS n_a, y.n AS n_b, n_records,
                     n_ab::DOUBLE * n_records / (x.n::DOUBLE * y.n) AS lift
              FROM p JOIN n x ON x.item = type_a JOIN n y ON y.item = type_b, t)"""
    words = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
    file_text = """list_reduce(list_prepend('', list_transform(nodes, lambda n: concat_ws(' ', n.name, n.type,
        list_aggregate(list_transform(list_sort(map_keys(n.parameters)), lambda k: concat_ws(' ', k, n.parameters[k])), 'string_agg', ' ')))),
        lambda x, y: x || ' ' || y)"""
    similar = f"""
        WITH f AS (SELECT file_id AS id, any_value({words.format(file_text)}) AS w FROM workflow_json WHERE len(nodes) > 0 GROUP BY file_id),
        m AS (SELECT wf_id AS id, any_value(array_to_string({words.format("name")}, ' ')) AS t FROM workflows WHERE name IS NOT NULL GROUP BY wf_id),
        s AS (SELECT DISTINCT 'nodes' AS field, id, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] AS x FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS k FROM f)
              UNION ALL SELECT DISTINCT 'name', id, substr(t, k, 3) FROM (SELECT id, t, unnest(range(1, length(t) - 1)) AS k FROM m WHERE length(t) >= 20)),
        n AS (SELECT field, id, count(*) AS n FROM s GROUP BY ALL),
        j AS (SELECT field, a.id AS id_a, b.id AS id_b, count(*) AS common FROM s a JOIN s b USING (field, x) WHERE a.id < b.id GROUP BY ALL)
        SELECT j.field AS field, id_a, id_b FROM j JOIN n a ON a.field = j.field AND a.id = id_a JOIN n b ON b.field = j.field AND b.id = id_b
        WHERE common * 10 >= 7 * (a.n + b.n - common)"""
    groups = f"""
        WITH RECURSIVE p AS MATERIALIZED ({similar}), e AS (SELECT field, id_a AS id, id_b AS other FROM p UNION ALL SELECT field, id_b, id_a FROM p),
        r AS (SELECT * FROM e UNION SELECT r.field, r.id, e.other FROM r JOIN e ON r.field = e.field AND r.other = e.id)
        SELECT field, id, min(other) AS group_id FROM r GROUP BY field, id"""
    windows = """
        WITH d AS (SELECT doc_id, any_value(text) AS t FROM documents WHERE length(text) >= 240 GROUP BY doc_id),
        w AS (SELECT doc_id, p, md5(substr(t, p, 240)) AS h FROM (SELECT doc_id, t, unnest(range(1, length(t) - 238)) AS p FROM d)),
        h AS (SELECT h FROM w GROUP BY h HAVING count(DISTINCT doc_id) > 1), s AS (SELECT doc_id, p, h FROM w SEMI JOIN h USING (h))"""
    bare = r"regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', '', 'g')"
    told = "coalesce('=' || {}, '~')"
    node = " || ".join([told.format(bare.format(f"n.{c}")) for c in ("id", "name", "type")] + [told.format("n.type_version::VARCHAR")])
    parameters = f"list_sort(list_transform(map_entries(n.parameters), lambda e: {bare.format('e.key')} || {told.format(bare.format('e.value'))}))"
    counts = rf"""
        WITH f AS (SELECT file_id, any_value(nodes) AS nodes, any_value(connections) AS c FROM workflow_json WHERE len(nodes) > 0 GROUP BY file_id),
        x AS (SELECT file_id, regexp_replace(lower(fullkey), '[^\p{{L}}\p{{N}}\[\]]', '', 'g') || '|' || CASE WHEN type IN ('OBJECT', 'ARRAY', 'NULL', 'BOOLEAN')
                     THEN type || coalesce(atom::VARCHAR, '') WHEN type = 'VARCHAR' THEN 'V' || {bare.format("atom->>'$'")} ELSE atom::DOUBLE::VARCHAR END AS x
              FROM (SELECT file_id, CASE WHEN json_valid(c) THEN c::JSON END AS j FROM f), json_tree(j)),
        t AS (SELECT file_id, string_agg(x, chr(10) ORDER BY x) AS told FROM x GROUP BY file_id),
        k AS (SELECT file_id, list_transform(nodes, lambda n: coalesce({node} || coalesce({parameters}::VARCHAR, '~'), '-'))::VARCHAR AS a,
                     CASE WHEN c IS NULL THEN 'null' WHEN t.file_id IS NULL THEN '!' || {bare.format("c")} ELSE told END AS b FROM f LEFT JOIN t USING (file_id))"""
    name_form = bare.format("filename")
    counted = f"""{counts} SELECT 'nodes' AS field, count(*) AS n, min(file_id) AS keep_id FROM k GROUP BY a, b
        UNION ALL SELECT 'filename', count(DISTINCT wf_id), min(wf_id) FROM workflows WHERE filename IS NOT NULL GROUP BY {name_form}"""
    found = f"""{counts}, m AS (SELECT 'nodes' AS field, min(file_id) OVER (PARTITION BY a, b) AS keep_id, file_id AS copy_id FROM k
        UNION SELECT 'filename', min(wf_id) OVER (PARTITION BY {name_form}), wf_id FROM workflows WHERE filename IS NOT NULL)
        SELECT field, keep_id, copy_id FROM m WHERE copy_id > keep_id"""
    return {
        "p1_counts": counted,
        "p1_found": found,
        "p2_found": similar,
        "p2_groups": groups,
        "p10_found": f"""{windows} SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM (SELECT DISTINCT doc_id, h FROM s) a
                         JOIN (SELECT DISTINCT doc_id, h FROM s) b USING (h) WHERE a.doc_id < b.doc_id""",
        "p10_shares": f"""{windows}, c AS (SELECT doc_id, sum(least(240, coalesce(next - p, 240)))::BIGINT AS n_shared FROM
                          (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS next FROM s) GROUP BY doc_id)
                          SELECT doc_id, coalesce(length(text), 0) AS n_chars, coalesce(n_shared, 0) AS n_shared,
                                 CASE WHEN length(text) > 0 THEN coalesce(n_shared, 0) / length(text) ELSE 0.0::DOUBLE END AS share
                          FROM documents LEFT JOIN c USING (doc_id)""",
        "p3_pairs": f"{pairs} SELECT * FROM s",
        "p3_found": f"""{pairs} SELECT type_a, type_b FROM s WHERE n_ab >= 5 AND n_ab * 50 >= n_records
                        AND n_ab * n_records * 2 >= n_a * n_b * 5""",
    }
