"""Hashes, message authentication, one-time passwords, units and binary encodings."""

from __future__ import annotations

import hashlib
import hmac
import struct

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(text: Column, kind: str = "sha256") -> Column:
    return {"md5": F.md5, "sha1": F.sha1, "sha256": lambda c: F.sha2(c, 256), "sha512": lambda c: F.sha2(c, 512)}[kind](text.cast("binary"))


def hmac_hex(message: Column, key: bytes, kind: str = "sha256") -> Column:
    """The keyed hash of a text in hexadecimal; null gives null."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else hmac.new(key, t.encode(), kind).hexdigest() for t in texts.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(message)


def one_time_code(secret: bytes, unix_seconds: int, digits: int = 6, period: int = 30) -> str:
    """A time-based one-time password (RFC 6238, SHA-1)."""
    mac = hmac.new(secret, struct.pack(">Q", unix_seconds // period), hashlib.sha1).digest()
    at = mac[-1] & 15
    return str((struct.unpack(">I", mac[at : at + 4])[0] & 0x7FFFFFFF) % 10**digits).zfill(digits)


def totp(unix_seconds: Column, secret: bytes, digits: int = 6, period: int = 30) -> Column:
    def run(times: pa.Array) -> pa.Array:
        return pa.array([None if t is None else one_time_code(secret, t, digits, period) for t in times.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(unix_seconds.cast("long"))


#: Factors to the base unit of each quantity; fixed values.
UNITS = {
    "m": ("length", 1.0), "km": ("length", 1000.0), "cm": ("length", 0.01), "mm": ("length", 0.001), "in": ("length", 0.0254), "ft": ("length", 0.3048),
    "kg": ("mass", 1.0), "g": ("mass", 0.001), "lb": ("mass", 0.45359237),
    "s": ("time", 1.0), "ms": ("time", 0.001), "min": ("time", 60.0), "h": ("time", 3600.0),
    "l": ("volume", 0.001), "ml": ("volume", 1e-6), "m3": ("volume", 1.0),
}


def convert_unit(value: Column, source: Column, target: Column) -> Column:
    """A value in another unit of the same quantity; null for unknown or unlike units."""
    pairs = [x for unit, (kind, factor) in UNITS.items() for x in (F.lit(unit), F.struct(F.lit(kind).alias("kind"), F.lit(factor).alias("factor")))]
    known = F.create_map(*pairs)
    a, b = known[source], known[target]
    return F.when(a["kind"] == b["kind"], value * a["factor"] / b["factor"])


def to_base64(text: Column) -> Column:
    return F.base64(text.cast("binary"))


def from_base64(text: Column, charset: str = "UTF-8") -> Column:
    return F.decode(F.unbase64(text), charset)
