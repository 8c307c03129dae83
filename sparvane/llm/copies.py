"""Copies hidden by formatting: canonical keys, and a ledger that counts them batch by batch.

The ledger keeps two bucketed tables: counts ``(field, key, n, keep_id)`` by key and the absorbed
``(field, id, key)`` by id. A batch is rid of ids that were absorbed before, aggregated by key (partly
before its shuffle, so a key that a third of the rows have costs one row per task), and
full-outer-joined with the counts, bucket by bucket: the ledger's side is never shuffled. Counts are added
and the earliest representative stays. A manifest names what is valid, so the ledger outlives its
session and a batch that broke off leaves no trace.
"""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import materialize, shared_dir

#: Rows that a bucket of the ledger is made for; with four times as many it is split.
BUCKET_ROWS = 1_000_000
_BARE = re.compile(r"[\W_]+")


def bare(text: Column) -> Column:
    """The lower-cased letters and digits of a text, joined; null stays null, ``--`` becomes empty."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "")


def _canonical(value) -> str:
    """One spelling per JSON value: bare strings, bare sorted keys, lists in order, 1 for 1.0."""
    if isinstance(value, dict):
        return "{" + ",".join(sorted(f"{_BARE.sub('', k.lower())}:{_canonical(v)}" for k, v in value.items())) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_canonical, value)) + "]"
    if isinstance(value, str):
        return '"' + _BARE.sub("", value.lower())
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    return repr(value)


def canonical_json(text: Column) -> Column:
    """A JSON text up to white space, field order, letter case and punctuation.

    Null gives null. What is no JSON (cut off, empty) is told apart from all JSON and compared by
    its bare form. Two fields whose bare names agree are both kept, in the order of their values.
    """

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            if t is not None:
                try:
                    t = _canonical(json.loads(t))
                except (ValueError, RecursionError):
                    t = "!" + _BARE.sub("", t.lower())
            out.append(t)
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")(text)


def _told(text: Column) -> Column:
    """Null apart from every text, so that concatenation keeps it."""
    return F.coalesce(F.concat(F.lit("\x02"), text), F.lit("\x03"))


def canonical_nodes(nodes: Column) -> Column:
    """Nodes in their order by bare id, name and type, version, and parameters as a map of bare texts."""

    def parameter(entry):
        return F.concat(bare(entry["key"]), _told(bare(entry["value"])))

    def node(n):
        entries = F.array_sort(F.transform(F.map_entries(n["parameters"]), parameter))
        told = [_told(bare(n[c])) for c in ("id", "name", "type")]
        return F.concat(*told, _told(n["type_version"].cast("string")), F.lit("\x04"), _told(F.array_join(entries, "\x01")))

    return F.array_join(F.transform(nodes, lambda n: F.coalesce(node(n), F.lit("\x05"))), "\x06")


def file_keys(files: DataFrame) -> DataFrame:
    """``(field, id, key)`` of workflow files with non-empty nodes; key is a 128-bit digest."""
    kept = files.where(F.size("nodes") > 0)
    told = F.concat(canonical_nodes(F.col("nodes")), F.lit("\x07"), _told(canonical_json(F.col("connections"))))
    return kept.select(F.lit("nodes").alias("field"), F.col("file_id").alias("id"), F.unhex(F.md5(told)).alias("key"))


def name_keys(rows: DataFrame, column: str = "filename", id_col: str = "wf_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(field, id, key)``, and what is to be kept, of rows with a non-null ``column``, by its bare form (which may be empty)."""
    kept = rows.where(F.col(column).isNotNull())
    return kept.select(F.lit(column).alias("field"), F.col(id_col).alias("id"), F.unhex(F.md5(bare(F.col(column)))).alias("key"), *keep)


class CopyLedger:
    """Counts per canonical key below ``path`` (by default in the shared folder); an existing ledger is opened.

    ``absorb(batch, name)`` takes ``(field, id, key)`` rows, for any number of batches. A batch whose name was
    absorbed before changes nothing, nor does an id that comes again, in the same batch or a later one: its
    first key counts. Rows with a null field, id or key are left out; an empty batch changes nothing. One writer at a time.
    """

    _COUNTS = "field string, key binary, n long, keep_id long"
    _MEMBERS = "field string, id long, key binary, batch long"

    def __init__(self, spark: SparkSession, path: str | None = None, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.bucket_rows = spark, bucket_rows
        self.path = (path or f"{shared_dir(spark)}/copy-ledger-{uuid.uuid4().hex[:8]}").rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.state = {"version": 0, "counts": None, "count_buckets": 0, "members": None, "member_buckets": 0, "batches": {}, "rows": 0}
        versions = sorted(int(x.getPath().getName()[9:-5]) for x in self._fs.globStatus(self._at("manifest-*.json")) or ())
        if versions:
            self.state = json.loads("".join(r[0] for r in spark.read.text(f"{self.path}/manifest-{versions[-1]}.json").collect()))

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _table(self, folder: str | None, schema: str, by: tuple[str, str], buckets: int) -> DataFrame:
        """A reader of a bucketed folder; the session's catalog is told how it is bucketed."""
        if folder is None:
            return self.spark.createDataFrame([], schema)
        name = f"sparvane_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({', '.join(by)}) INTO {buckets} BUCKETS LOCATION '{self.path}/{folder}'")
        rows = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the frame keeps what it needs; the files stay
        return rows

    def _write(self, rows: DataFrame, folder: str, by: tuple[str, str], buckets: int, mode: str = "error") -> None:
        name = f"sparvane_{uuid.uuid4().hex}"
        if mode == "append":
            self.spark.sql(f"CREATE TABLE {name} ({self._MEMBERS}) USING parquet CLUSTERED BY ({', '.join(by)}) INTO {buckets} BUCKETS LOCATION '{self.path}/{folder}'")
            rows.write.insertInto(name)
        else:
            rows.write.format("parquet").bucketBy(buckets, *by).option("path", f"{self.path}/{folder}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # its files stay

    def _buckets(self, rows: int) -> int:
        """A power of two with at most ``bucket_rows`` rows each."""
        return 1 << max(2, (max(rows, 1) - 1) // self.bucket_rows).bit_length()

    def members(self) -> DataFrame:
        """``(field, id, key)`` of what was absorbed."""
        s = self.state
        rows = self._table(s["members"], self._MEMBERS, ("field", "id"), s["member_buckets"])
        return rows.where(F.col("batch").isin(list({*s["batches"].values()}))).select("field", "id", "key")

    def absorb(self, batch: DataFrame, name: str | None = None) -> CopyLedger:
        name, s = name or uuid.uuid4().hex, dict(self.state)
        if name in s["batches"]:
            return self
        rows = batch.where(F.col("field").isNotNull() & F.col("id").isNotNull() & F.col("key").isNotNull())
        rows = rows.groupBy("field", "id").agg(F.min("key").alias("key"))
        if s["members"]:
            rows = rows.join(self.members().select("field", "id"), ["field", "id"], "left_anti")
        fresh = materialize(rows, "ledger-batch")
        n = fresh.count()
        number = uuid.uuid4().int >> 65  # not that of a batch that broke off
        s |= {"version": s["version"] + 1, "rows": s["rows"] + n, "batches": s["batches"] | {name: number}}
        if n:
            many = self._buckets(s["rows"])
            by_id, by_key = ("field", "id"), ("field", "key")
            if many > 4 * s["member_buckets"]:  # more buckets than before: the absorbed ids are written anew
                mine = fresh.union(self.members()) if s["members"] else fresh
                s |= {"members": f"members-{number}", "member_buckets": many, "batches": dict.fromkeys(s["batches"], number)}
                self._write(mine.withColumn("batch", F.lit(number)).repartition(many, *by_id), s["members"], by_id, many)
            else:
                mine = fresh.withColumn("batch", F.lit(number)).repartition(s["member_buckets"], *by_id)
                self._write(mine, s["members"], by_id, s["member_buckets"], "append")
            news = fresh.groupBy(*by_key).agg(F.count("*").alias("n"), F.min("id").alias("keep_id"))
            if s["counts"]:
                old = self._table(s["counts"], self._COUNTS, by_key, s["count_buckets"]).withColumnsRenamed({"n": "old_n", "keep_id": "old_id"})
                total = F.coalesce("n", F.lit(0)) + F.coalesce("old_n", F.lit(0))
                news = news.join(old, list(by_key), "full_outer").select(*by_key, total.alias("n"), F.least("keep_id", "old_id").alias("keep_id"))
            if many > 4 * s["count_buckets"]:
                s["count_buckets"] = many
                news = news.repartition(many, *by_key)
            s["counts"] = f"counts-{number}"
            self._write(news, s["counts"], by_key, s["count_buckets"])
        self._commit(s)
        return self

    def _commit(self, state: dict) -> None:
        """The manifest appears at once, by renaming; what it no longer names is deleted."""
        at = self._at(f".manifest-{state['version']}")
        stream = self._fs.create(at, True)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        if not self._fs.rename(at, self._at(f"manifest-{state['version']}.json")):
            raise RuntimeError(f"another writer has made version {state['version']} of the ledger")
        before, self.state = self.state, state
        for name in ("counts", "members"):
            if before[name] and before[name] != state[name]:
                self._fs.delete(self._at(before[name]), True)
        if before["version"]:
            self._fs.delete(self._at(f"manifest-{before['version']}.json"), False)

    def counts(self) -> DataFrame:
        """``(field, key, n, keep_id)``: each record once, with the number of its copies."""
        return self._table(self.state["counts"], self._COUNTS, ("field", "key"), self.state["count_buckets"])

    def copies(self) -> DataFrame:
        """``(field, keep_id, copy_id)``: one row per copy among what was absorbed."""
        several = self.counts().where("n > 1")
        found = self.members().join(several, ["field", "key"]).where("id > keep_id")
        return found.select("field", "keep_id", F.col("id").alias("copy_id"))


def absorb_deliveries(ledger: CopyLedger, rows: DataFrame, number: int = 3) -> CopyLedger:
    """All of ``rows`` (``field, id, key`` and what else tells deliveries apart) in ``number`` batches.

    Which batch a row comes in is told by a hash of the whole row, so batches share keys, and ids that were
    delivered twice with other values mostly come in two batches.
    """
    which = F.pmod(F.xxhash64(*rows.columns), F.lit(number))
    return reduce(lambda held, k: held.absorb(rows.where(which == k), f"delivery-{k}"), range(number), ledger)
