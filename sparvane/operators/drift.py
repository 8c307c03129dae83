"""Schemas that drift between files: one table out of all of them, and every change on record.

Each file's header is read in parallel, one parse per body: which shapes (fields in order, with
their JSON types) its objects have, per level. Files share their shapes, so the shapes are a small
table of their own; headers name them by a digest. All else follows from the two tables: the types
met are folded through a lattice, ``null < boolean < number < string``, with lists and objects below
string too, into the union schema; stand-ins, changes and the log of ordered differences are worked
out once per shape. Files are cast to the agreed layout, whose columns come from ``schema_fields``.
What the union schema has beyond it is kept as JSON beside its object.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ..runtime import materialize
from .flatten import sound

#: The lattice: the join of two types is the larger; objects and lists have only text above them.
LATTICE = ("null", "boolean", "number", "string", "array", "object")
#: Shapes that a task remembers having given out; beyond it some are given out again.
_REMEMBERED = 50_000


def json_type(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    return {str: "string", list: "array"}.get(type(value), "object")


def promote(a: str, b: str) -> str:
    """The least type that holds values of both: scalars meet in the wider one, anything else in string."""
    if a == b or b == "null":
        return a
    if a == "null":
        return b
    if {a, b} & {"array", "object"}:
        return "string"
    return max(a, b, key=LATTICE.index)


class Layout:
    """The agreed fields per level: name, JSON type, whether required."""

    def __init__(self, rows):
        self.fields: dict[str, dict[str, tuple[str, bool]]] = {}
        for r in rows:
            self.fields.setdefault(r["level"], {})[r["field"]] = (r["json_type"], r["required"])

    @classmethod
    def read(cls, schema_fields: DataFrame) -> Layout:
        return cls(schema_fields.select("level", "field", "json_type", "required").orderBy("level", "field").collect())  # a fixed, short table

    def agreed(self) -> Column:
        """Whether the row's ``level`` and ``field`` are in the layout."""
        out = F.lit(False)
        for level, fields in self.fields.items():
            out = out | ((F.col("level") == level) & F.col("field").isin(list(fields)))
        return out


def objects_of(body: dict) -> Iterator[tuple[str, dict]]:
    """The file, its nodes where they are a list, and its links where connections are an object."""
    yield "file", body
    if isinstance(body.get("nodes"), list):
        yield from (("node", n) for n in body["nodes"] if isinstance(n, dict))
    if isinstance(body.get("connections"), dict):
        for ports in body["connections"].values():
            for slots in ports.values() if isinstance(ports, dict) else ():
                for links in slots if isinstance(slots, list) else ():
                    yield from (("link", x) for x in (links if isinstance(links, list) else ()) if isinstance(x, dict))


def _refuse(constant: str):
    raise ValueError(f"{constant} is no JSON")


def _whole(digits: str) -> int | float:
    return int(digits) if len(digits) < 1000 else float(digits)


def _sound(value):
    """A JSON value whose texts have no halves of surrogate pairs that stand alone."""
    if isinstance(value, str):
        return sound(value)
    if isinstance(value, list):
        return [_sound(x) for x in value]
    return {sound(k): _sound(x) for k, x in value.items()} if isinstance(value, dict) else value


def parsed(body: str | None):
    """The object that a body is, or None."""
    if body is None:
        return None
    try:
        value = json.loads(body, parse_constant=_refuse, parse_int=_whole)
        if "\\ud" in body or "\\uD" in body:
            value = _sound(value)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def stand_ins(level: str, types: dict[str, str], layout: Layout, weight: dict) -> dict[str, str]:
    """Unknown fields that stand in for missing required ones: ``{agreed: unknown}``; ``types`` by field, in order.

    They must be of the agreed type. Of several, the pair that is met most in all files goes first
    (``weight`` of ``(agreed, unknown)``), then the one that comes first.
    """
    agreed = layout.fields.get(level, {})
    missing = [f for f, (_, required) in agreed.items() if required and f not in types]
    if not missing:
        return {}
    unknown = [(k, f, t) for k, (f, t) in enumerate(types.items()) if f not in agreed]
    pairs = [(-weight.get((f, u), 0.0), k, f, u) for f in missing for k, u, t in unknown if t == agreed[f][0]]
    out: dict[str, str] = {}
    for _, _, f, u in sorted(pairs):
        if f not in out and u not in out.values():
            out[f] = u
    return out


def changes_of(level: str, types: dict[str, str], layout: Layout, instead: dict[str, str]) -> Iterator[tuple[str, str, str | None]]:
    """``(field, change, detail)`` of one shape against the layout."""
    agreed = layout.fields.get(level, {})
    for f, (kind, required) in agreed.items():
        if f in instead:
            yield f, "renamed", instead[f]
        elif f not in types and required:
            yield f, "removed", None
        elif types.get(f, "null") not in ("null", kind):
            yield f, "retyped", types[f]
    for f, t in types.items():
        if f not in agreed and f not in instead.values():
            yield f, "added", t


def shape_of(level: str, obj: dict) -> tuple[bytes, list[str], list[str]]:
    """Digest, fields and types of an object, in its own order."""
    fields, types = list(obj), [json_type(v) for v in obj.values()]
    told = json.dumps([level, fields, types], ensure_ascii=True)
    return hashlib.blake2b(told.encode(), digest_size=16).digest(), fields, types


def _header_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, body) to a row per file and shape; the first of a task spells the shape out."""
    known: set[bytes] = set()
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()))
    for batch in batches:
        rows = []
        for key, body in zip(batch.column(0).to_pylist(), map(parsed, batch.column(1).to_pylist())):
            if body is None:
                continue
            own: dict[bytes, list] = {}
            for level, obj in objects_of(body):
                shape, fields, types = shape_of(level, obj)
                if shape in own:
                    own[shape][3] += 1
                    continue
                fresh = shape not in known
                known.add(shape)
                own[shape] = [key, level, shape, 1, fields if fresh else None, types if fresh else None]
            rows += own.values()
            if len(known) > _REMEMBERED:
                known.clear()
        columns = list(zip(*rows)) if rows else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["id", "level", "shape", "n", "fields", "types"])


class Headers:
    """What the headers of ``files`` (an id and ``body``) say, against the agreed ``layout``.

    Null, empty and broken bodies, and bodies that are no object, have no header. A body delivered
    twice under its id counts once.
    """

    def __init__(self, files: DataFrame, layout: Layout, id_col: str = "raw_id"):
        self.layout, self.id_col = layout, id_col
        schema = "id long, level string, shape binary, n long, fields array<string>, types array<string>"
        rows = materialize(files.select(F.col(id_col).cast("long").alias("id"), "body").mapInArrow(_header_rows, schema), "headers")
        self.files = rows.select("id", "level", "shape", "n").distinct()
        spelt = rows.where("fields is not null").groupBy("shape").agg(F.first("level").alias("level"), F.first("fields").alias("fields"), F.first("types").alias("types"))
        times = self.files.groupBy("shape").agg(F.sum("n").alias("n"))
        self.shapes = materialize(spelt.join(times, "shape"), "shapes")

    def union_schema(self) -> DataFrame:
        """``(level, field, json_type, n_objects, agreed)``: every field met, with the fold of its types."""
        fields = self.shapes.select("level", "n", F.explode(F.arrays_zip("fields", "types")).alias("x"))
        met = fields.groupBy("level", F.col("x.fields").alias("field"), F.col("x.types").alias("type")).agg(F.sum("n").alias("n"))
        pairs = [x for a in LATTICE for b in LATTICE for x in (F.lit(f"{a} {b}"), F.lit(promote(a, b)))]
        joined = F.create_map(*pairs)
        fold = F.aggregate(F.array_sort(F.collect_list("type")), F.lit("null"), lambda a, b: joined[F.concat_ws(" ", a, b)])  # a row per type
        return met.groupBy("level", "field").agg(fold.alias("json_type"), F.sum("n").alias("n_objects")).withColumn("agreed", self.layout.agreed())

    def _judged(self) -> DataFrame:
        """``(shape, level, changes, instead)`` of each shape that differs from the layout or has stand-ins."""
        layout = self.layout

        def beside(batches):
            for batch in batches:
                rows = []
                for shape, level, fields, types in zip(*(c.to_pylist() for c in batch.columns)):
                    types, agreed = dict(zip(fields, types)), layout.fields.get(level, {})
                    missing = [f for f, (_, required) in agreed.items() if required and f not in types]
                    rows += [(shape, level, f, u) for f in missing for u, t in types.items() if u not in agreed and t == agreed[f][0]]
                columns = list(zip(*rows)) if rows else [[]] * 4
                kinds = (pa.binary(), *[pa.string()] * 3)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["shape", "level", "missing", "field"])

        # How much of an unknown field's use is beside the missing agreed field, over all files.
        spelt = self.shapes.select("shape", "level", "fields", "types")
        pairs = materialize(spelt.mapInArrow(beside, "shape binary, level string, missing string, field string"), "stand-ins")
        counted = pairs.join(self.shapes.select("shape", "n"), "shape").groupBy("level", "missing", "field").agg(F.sum("n").alias("n"))
        totals = self.union_schema().select("level", "field", F.col("n_objects").alias("total"))
        weights = counted.join(totals, ["level", "field"]).select("level", "missing", "field", (F.col("n") / F.col("total")).alias("weight"))
        weighed = pairs.join(weights, ["level", "missing", "field"]).groupBy("shape").agg(F.collect_list(F.struct("missing", "field", "weight")).alias("weights"))

        def judge(batches):
            kinds = (pa.binary(), pa.string(), pa.list_(pa.struct([("field", pa.string()), ("change", pa.string()), ("detail", pa.string())])), pa.map_(pa.string(), pa.string()))
            for batch in batches:
                rows = []
                for shape, level, fields, types, weights in zip(*(c.to_pylist() for c in batch.columns)):
                    types = dict(zip(fields, types))
                    instead = stand_ins(level, types, layout, {(w["missing"], w["field"]): w["weight"] for w in weights or ()})
                    found = [dict(zip(("field", "change", "detail"), c)) for c in changes_of(level, types, layout, instead)]
                    if found:
                        rows.append((shape, level, found, list(instead.items())))
                columns = list(zip(*rows)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["shape", "level", "changes", "instead"])

        schema = "shape binary, level string, changes array<struct<field:string,change:string,detail:string>>, instead map<string,string>"
        return materialize(spelt.join(weighed, "shape", "left").mapInArrow(judge, schema), "judged")

    def changes(self) -> DataFrame:
        """``(id, level, field, change, detail)``, distinct, of each file.

        ``detail`` is the stand-in's name, the other type, or the added field's type.
        """
        found = self.files.select("id", "shape").join(self._judged(), "shape").select("id", "level", F.explode("changes").alias("c"))
        return found.select(F.col("id").alias(self.id_col), "level", "c.*").distinct()

    def renamed(self) -> DataFrame:
        """``(id, renamed)``: of files with stand-ins, those of each shape that has some."""
        some = self._judged().where(F.size("instead") > 0).select("shape", "instead")
        of_file = self.files.select("id", "shape").distinct().join(some, "shape")
        return of_file.groupBy("id").agg(F.collect_list(F.struct("shape", "instead")).alias("renamed"))  # at most a file's own shapes


def union_schema(files: DataFrame, layout: Layout) -> DataFrame:
    """``Headers.union_schema`` of the files."""
    return Headers(files, layout).union_schema()


def changes(files: DataFrame, schema_fields: DataFrame, id_col: str = "raw_id") -> DataFrame:
    """``Headers.changes`` of the files against the agreed layout."""
    return Headers(files, Layout.read(schema_fields), id_col).changes()


def change_log(files: DataFrame, schema_fields: DataFrame) -> DataFrame:
    """``(level, field, change, detail, first_seen, last_seen, n_files)``, in the order of first appearance."""
    dated = files.groupBy("raw_id").agg(F.min("exported_at").alias("exported_at"))
    found = changes(files, schema_fields).join(dated, "raw_id")
    log = found.groupBy("level", "field", "change", "detail").agg(
        F.min("exported_at").alias("first_seen"), F.max("exported_at").alias("last_seen"), F.count_distinct("raw_id").alias("n_files")
    )
    return log.orderBy("first_seen", "level", "field", "change", "detail")


def cast(value, kind: str):
    """A value as the agreed type; objects and lists as JSON text, what cannot be cast as null."""
    if value is None:
        return None
    if kind == "boolean":
        if isinstance(value, (bool, int, float)):
            return bool(value)
        return {"true": True, "1": True, "yes": True, "false": False, "0": False, "no": False}.get(str(value).strip().lower())
    if kind == "number":
        if isinstance(value, dict):
            return None
        try:
            return float(str(value).strip().lstrip("vV")) if not isinstance(value, list) else None
        except ValueError:
            return None
    if kind == "string" and isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


_TYPES = {"number": pa.float64(), "boolean": pa.bool_()}  # all else is text: strings as they are, lists and objects as JSON


def column_name(field: str) -> str:
    """``typeVersion`` as ``type_version``."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", field).lower()


def table_schema(layout: Layout) -> pa.Schema:
    """The columns of ``uniform``: the agreed fields of files, nodes and links, each level with its ``extra``."""

    def fields(level, without=()):
        return [(column_name(f), _TYPES.get(kind, pa.string())) for f, (kind, _) in layout.fields.get(level, {}).items() if f not in without]

    extra = ("extra", pa.string())
    place = [("source", pa.string()), ("port", pa.string()), ("slot", pa.int32())]
    node, link = pa.struct([*fields("node"), extra]), pa.struct([*place, *fields("link"), extra])
    return pa.schema([("raw_id", pa.int64()), *fields("file", ("nodes", "connections")), ("nodes", pa.list_(node)), ("links", pa.list_(link)), extra])


def uniform(files: DataFrame, schema_fields: DataFrame) -> DataFrame:
    """One row per parsable file in the agreed layout; the latest delivery of each ``raw_id`` counts.

    Columns and types come from ``schema_fields``. Fields under a stand-in's name are moved to the agreed
    one, values of other types are cast. What that leaves no place for stays, as JSON, in the ``extra`` of
    its file, node or link: fields that only the union schema has, values that cannot be cast, and nodes or
    connections that hold anything of another shape.
    """
    layout = Layout.read(schema_fields)
    headers = Headers(files, layout)
    schema = table_schema(layout)

    def told(extra):
        return json.dumps(extra, ensure_ascii=False) if extra else None

    def row(level, obj, renamed):
        instead = renamed.get(shape_of(level, obj)[0], {}) if renamed else {}
        agreed = layout.fields.get(level, {})
        out = {f: cast(obj.get(instead.get(f, f)), kind) for f, (kind, _) in agreed.items()}
        placed = {instead.get(f, f) for f, v in out.items() if v is not None}
        extra = {f: v for f, v in obj.items() if f not in placed and (v is not None or f not in out)}
        return {column_name(f): v for f, v in out.items()}, extra, instead

    def one(key, body, renamed):
        out, extra, named = row("file", body, renamed)
        body = body | {f: body[u] for f, u in named.items()}
        nodes, links, odd = [], [], set()

        def each(value, kind, field):
            """The members of a list or object; a value of another type but null is kept in the file's ``extra``."""
            if isinstance(value, kind):
                return value.items() if kind is dict else value
            if value is not None:
                odd.add(field)
            return ()

        for n in each(body.get("nodes"), list, "nodes"):
            each(n, dict, "nodes")
            if isinstance(n, dict):
                x, more, _ = row("node", n, renamed)
                nodes.append(x | {"extra": told(more)})
        for source, ports in each(body.get("connections"), dict, "connections"):
            for port, slots in each(ports, dict, "connections"):
                for slot, some in enumerate(each(slots, list, "connections")):
                    for n in each(some, list, "connections"):
                        each(n, dict, "connections")
                        if isinstance(n, dict):
                            x, more, _ = row("link", n, renamed)
                            links.append({"source": source, "port": port, "slot": slot} | x | {"extra": told(more)})
        return out | {"raw_id": key, "nodes": nodes, "links": links, "extra": told(extra | {f: body[f] for f in sorted(odd)})}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = []
                for key, body, renamed in zip(part.column(0).to_pylist(), map(parsed, part.column(1).to_pylist()), part.column(2).to_pylist()):
                    if body is not None:
                        rows.append(one(key, body, {x["shape"]: dict(x["instead"]) for x in renamed or ()}))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    # Of deliveries at the same time the greater body counts.
    newest = F.max(F.struct("loaded_at", "exported_at", "body"))
    latest = files.groupBy(F.col("raw_id").cast("long").alias("id")).agg(newest.alias("r")).select("id", "r.body")
    placed = latest.join(headers.renamed(), "id", "left").select("id", "body", "renamed")
    return placed.mapInArrow(run, from_arrow_schema(schema))
