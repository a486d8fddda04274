"""Avro binary encoding of one datum, driven by a parsed schema.

A small per-record helper for the ``mapInPandas`` decode/encode operators
(the spark-avro connector is not on this image's classpath; where it is,
``from_avro``/``to_avro`` run in the JVM instead). Covers the Avro 1.x
binary spec: null, boolean, int, long, float, double, bytes, string,
record, enum, array, map, union, fixed.
"""

from __future__ import annotations

import json
import struct
from typing import Any


class AvroError(ValueError):
    pass


PRIMITIVES = ("null", "boolean", "int", "long", "float", "double", "bytes", "string")


def parse_schema(text: str) -> Any:
    """Schema JSON → tree with named types resolved (logical types ignored)."""
    names: dict[str, Any] = {}

    def resolve(s: Any, ns: str | None = None) -> Any:
        if isinstance(s, list):
            return [resolve(x, ns) for x in s]
        if isinstance(s, str):
            if s in PRIMITIVES:
                return s
            full = s if "." in s or not ns else f"{ns}.{s}"
            if full in names or s in names:
                return names.get(full) or names[s]
            raise AvroError(f"unknown type {s!r}")
        t = s["type"]
        if t in PRIMITIVES:
            return t
        if t in ("record", "error", "enum", "fixed"):
            ns = s.get("namespace", ns)
            node = dict(s)
            names[s["name"]] = node
            if ns:
                names[f"{ns}.{s['name']}"] = node
            if t in ("record", "error"):
                node["fields"] = [dict(f, type=resolve(f["type"], ns)) for f in s["fields"]]
            return node
        if t == "array":
            return dict(s, items=resolve(s["items"], ns))
        if t == "map":
            return dict(s, values=resolve(s["values"], ns))
        return resolve(t, ns)

    return resolve(json.loads(text))


class _Reader:
    __slots__ = ("buf", "pos")

    def __init__(self, buf: bytes):
        self.buf, self.pos = buf, 0

    def take(self, n: int) -> bytes:
        if n < 0 or self.pos + n > len(self.buf):
            raise AvroError("truncated datum")
        b = self.buf[self.pos : self.pos + n]
        self.pos += n
        return b

    def long(self) -> int:
        buf, pos = self.buf, self.pos
        if pos < len(buf):
            b = buf[pos]
            if b < 0x80:  # one-byte varint, the common case
                self.pos = pos + 1
                return (b >> 1) ^ -(b & 1)
        shift = result = 0
        while True:
            if self.pos >= len(self.buf):
                raise AvroError("truncated varint")
            b = self.buf[self.pos]
            self.pos += 1
            result |= (b & 0x7F) << shift
            if not b & 0x80:
                break
            shift += 7
            if shift > 63:
                raise AvroError("varint too long")
        if result >> 64:
            raise AvroError("varint beyond 64 bits")
        return (result >> 1) ^ -(result & 1)


def decode(payload: bytes, schema: Any) -> Any:
    """Decode one datum from the start of ``payload`` (bytes after it are
    ignored, as a datum reader does)."""
    return compiled_reader(schema)(_Reader(payload))


# --- schema-compiled readers/writers: one closure per schema node, built once
# per parsed schema, so a record is read or written without type dispatch.

def compiled_reader(schema: Any):
    """Reader for a parsed schema, compiled once and kept on the schema."""
    if isinstance(schema, dict):
        fn = schema.get("__reader")
        if fn is None:
            fn = schema["__reader"] = _compile_read(schema)
        return fn
    return _compile_read(schema)


def compiled_writer(schema: Any):
    """Writer for a parsed schema, compiled once and kept on the schema."""
    if isinstance(schema, dict):
        fn = schema.get("__writer")
        if fn is None:
            fn = schema["__writer"] = _compile_write(schema)
        return fn
    return _compile_write(schema)


def _kind(s: Any) -> str:
    return s if isinstance(s, str) else s.get("type") if isinstance(s, dict) else "union"


def _compile_read(s: Any):
    t = _kind(s)
    if t == "null":
        return lambda r: None
    if t == "boolean":
        return lambda r: r.take(1) != b"\x00"
    if t in ("int", "long"):
        return _Reader.long
    if t == "float":
        return lambda r: struct.unpack("<f", r.take(4))[0]
    if t == "double":
        return lambda r: struct.unpack("<d", r.take(8))[0]
    if t == "bytes":
        return lambda r: r.take(r.long())
    if t == "string":
        return lambda r: r.take(r.long()).decode("utf-8")
    if t in ("record", "error"):
        fields = [(f["name"], _compile_read(f["type"])) for f in s["fields"]]

        def read_record(r):
            return {name: fn(r) for name, fn in fields}

        return read_record
    if t == "enum":
        symbols = s["symbols"]

        def read_enum(r):
            i = r.long()
            if not 0 <= i < len(symbols):
                raise AvroError("bad enum index")
            return symbols[i]

        return read_enum
    if t == "fixed":
        size = s["size"]
        return lambda r: r.take(size)
    if t == "array":
        item = _compile_read(s["items"])

        def read_array(r):
            out = []
            while True:
                n = r.long()
                if n == 0:
                    return out
                if n < 0:
                    n = -n
                    r.long()
                for _ in range(n):
                    out.append(item(r))

        return read_array
    if t == "map":
        value = _compile_read(s["values"])

        def read_map(r):
            out = {}
            while True:
                n = r.long()
                if n == 0:
                    return out
                if n < 0:
                    n = -n
                    r.long()
                for _ in range(n):
                    k = r.take(r.long()).decode("utf-8")
                    out[k] = value(r)

        return read_map
    if t == "union":
        branches = [_compile_read(b) for b in s]

        def read_union(r):
            i = r.long()
            if not 0 <= i < len(branches):
                raise AvroError("bad union branch")
            return branches[i](r)

        return read_union
    raise AvroError(f"unsupported type {t!r}")


def _compile_write(s: Any):
    t = _kind(s)
    if t in ("record", "error"):
        fields = [(f["name"], _compile_write(f["type"])) for f in s["fields"]]

        def write_record(out, v):
            for name, fn in fields:
                fn(out, v[name])

        return write_record
    if t in ("int", "long"):
        return lambda out, v: out.extend(_zigzag(int(v)))
    if t == "array":
        item = _compile_write(s["items"])

        def write_array(out, v):
            items = list(v)
            if items:
                out += _zigzag(len(items))
                for x in items:
                    item(out, x)
            out.append(0)

        return write_array
    if t in ("string", "bytes"):
        def write_bytes(out, v):
            b = v.encode("utf-8") if t == "string" else bytes(v)
            out += _zigzag(len(b))
            out += b

        return write_bytes
    if t == "null":
        return lambda out, v: None
    if t == "boolean":
        return lambda out, v: out.append(1 if v else 0)
    if t == "float":
        return lambda out, v: out.extend(struct.pack("<f", v))
    if t == "double":
        return lambda out, v: out.extend(struct.pack("<d", v))
    if t == "enum":
        symbols = s["symbols"]
        return lambda out, v: out.extend(_zigzag(symbols.index(v)))
    if t == "fixed":
        return lambda out, v: out.extend(bytes(v))
    if t == "map":
        value = _compile_write(s["values"])

        def write_map(out, v):
            if v:
                out += _zigzag(len(v))
                for k, x in v.items():
                    kb = k.encode("utf-8")
                    out += _zigzag(len(kb))
                    out += kb
                    value(out, x)
            out.append(0)

        return write_map
    if t == "union":
        branches = [(i, _kind(b) == "null", _compile_write(b)) for i, b in enumerate(s)]

        def write_union(out, v):
            for i, is_null, fn in branches:
                if (v is None) == is_null:
                    out += _zigzag(i)
                    fn(out, v)
                    return
            raise AvroError("no union branch fits")

        return write_union
    raise AvroError(f"unsupported type {t!r}")


# Encoded varints of the zig-zag values below 2^14 (one or two bytes).
_SMALL_VARINTS = [bytes((z,)) if z < 0x80 else bytes(((z & 0x7F) | 0x80, z >> 7)) for z in range(1 << 14)]


def _zigzag(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    if n < (1 << 14):
        return _SMALL_VARINTS[n]
    out = bytearray()
    while n & ~0x7F:
        out.append((n & 0x7F) | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def encode(value: Any, schema: Any) -> bytes:
    out = bytearray()
    compiled_writer(schema)(out, value)
    return bytes(out)
