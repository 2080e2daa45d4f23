"""The column type language: tokenizer, parser, and the Spark type that holds each type's values.

Type strings nest, e.g. Map(String, Array(Nullable(Int32))). Quoted names may hold any character, back-ticked element
names any but a back-tick, and time zones are accepted on second-precision timestamps too.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

INT_BITS = {f"{u}Int{b}": (b, u == "") for u in ("", "U") for b in (8, 16, 32, 64, 128, 256)}
_TOKEN = re.compile(r"\s*(?:(?P<quoted>'(?:[^'\\]|\\.|'')*')|(?P<tick>`[^`]*`)|(?P<number>-?\d+)(?![A-Za-z_])|(?P<name>[A-Za-z_][\w.]*)|(?P<mark>[(),=]))", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "0": "\0"}


class TypeError_(ValueError):
    """A type string that can't be read."""


@dataclass(frozen=True)
class ColType:
    name: str
    args: tuple["ColType", ...] = ()
    names: tuple[str | None, ...] = ()
    numbers: tuple[int, ...] = ()
    labels: tuple[tuple[str, int], ...] = ()
    zone: str | None = None

    def __str__(self) -> str:
        if self.labels:
            inner = ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + f"' = {v}" for n, v in self.labels)
        elif self.args:
            inner = ", ".join(f"{n} {a}" if n else str(a) for n, a in zip(self.names or (None,) * len(self.args), self.args, strict=True))
        else:
            inner = ", ".join([*map(str, self.numbers), *([f"'{self.zone}'"] if self.zone else [])])
        return f"{self.name}({inner})" if inner else self.name

    @property
    def is_nullable(self) -> bool:
        return self.name in ("Nullable", "Variant", "Dynamic")

    def unwrapped(self) -> "ColType":
        """Without Nullable and LowCardinality."""
        return self.args[0].unwrapped() if self.name in ("Nullable", "LowCardinality") else self


@dataclass
class _Reader:
    tokens: list[tuple[str, str]]
    at: int = field(default=0)

    def peek(self, ahead: int = 0) -> tuple[str, str]:
        return self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else ("end", "")

    def take(self, kind: str | None = None, value: str | None = None) -> str:
        k, v = self.peek()
        if (kind and k != kind) or (value and v != value):
            raise TypeError_(f"expected {value or kind}, found {v or 'the end'}")
        self.at += 1
        return v


def _tokens(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    text = text.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise TypeError_(f"can't read the type at {text[at:at + 20]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


def unquote(text: str) -> str:
    return re.sub(r"\\(.)|''", lambda m: "'" if m[1] is None else _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S)


#: Types without arguments.
PLAIN = {*INT_BITS, "Float32", "Float64", "Bool", "String", "UUID", "IPv4", "IPv6", "Date", "Date32", "Dynamic", "Point", "Ring", "Polygon", "MultiPolygon"}
DECIMAL_DIGITS = {"Decimal32": 9, "Decimal64": 18, "Decimal128": 38, "Decimal256": 76}


def _type(r: _Reader) -> ColType:
    name = r.take("name")
    if r.peek() != ("mark", "("):
        if name in PLAIN or name in ("DateTime", "DateTime64", "JSON", "Decimal"):
            return ColType(name, numbers={"DateTime64": (3,), "Decimal": (10, 0)}.get(name, ()))
        raise TypeError_(f"Unknown type: {name}")
    r.take("mark", "(")
    if name in ("Nullable", "Array", "LowCardinality"):
        out = ColType(name, (_type(r),))
    elif name == "Map":
        key = _type(r)
        r.take("mark", ",")
        out = ColType(name, (key, _type(r)))
    elif name in ("Tuple", "Nested", "Variant"):
        elements = _list(r, lambda: _element(r, name))
        if name == "Nested" and any(n is None for n, _ in elements):
            raise TypeError_("Nested needs element names")
        out = ColType(name, tuple(t for _, t in elements), tuple(n for n, _ in elements))
    elif name in ("Enum8", "Enum16"):
        labels = _list(r, lambda: _label(r))
        bits = 8 if name == "Enum8" else 16
        values, at = [], 1
        for text, value in labels:
            at = value if value is not None else at
            if not -(1 << bits - 1) <= at < 1 << bits - 1:
                raise TypeError_(f"{name}: {at} is out of range")
            values.append((text, at))
            at += 1
        if len({n for n, _ in values}) < len(values) or len({v for _, v in values}) < len(values):
            raise TypeError_(f"{name}: a name or a value comes twice")
        out = ColType(name, labels=tuple(values))
    elif name == "FixedString":
        out = ColType(name, numbers=(int(r.take("number")),))
    elif name == "Decimal" or name in DECIMAL_DIGITS:
        numbers = tuple(_list(r, lambda: int(r.take("number"))))
        precision, scale = (DECIMAL_DIGITS[name], numbers[0]) if name != "Decimal" else (numbers[0], numbers[1] if len(numbers) > 1 else 0)
        if not 0 < precision <= 76 or not 0 <= scale <= precision:
            raise TypeError_(f"{name}: wrong precision or scale")
        out = ColType("Decimal", numbers=(precision, scale))
    elif name == "DateTime":
        out = ColType(name, zone=unquote(r.take("quoted")))
    elif name == "DateTime64":
        precision, zone = int(r.take("number")), None
        if r.peek()[1] == ",":
            r.take()
            zone = unquote(r.take("quoted"))
        if not 0 <= precision <= 9:
            raise TypeError_("DateTime64: precision must be 0 to 9")
        out = ColType(name, numbers=(precision,), zone=zone)
    elif name == "JSON":
        paths = [p for p in _list(r, lambda: _json_path(r)) if p]
        out = ColType(name, tuple(t for _, t in paths), tuple(n for n, _ in paths))
    else:
        raise TypeError_(f"Unknown type: {name}")
    r.take("mark", ")")
    return out


def _list(r: _Reader, one) -> list:
    out = [one()]
    while r.peek()[1] == ",":
        r.take()
        out.append(one())
    return out


def _element(r: _Reader, of: str) -> tuple[str | None, ColType]:
    kind, _ = r.peek()
    named = kind == "tick" or (of != "Variant" and kind == "name" and r.peek(1)[0] in ("name", "tick"))
    name = (r.take().strip("`")) if named else None
    return name, _type(r)


def _label(r: _Reader) -> tuple[str, int | None]:
    name = unquote(r.take("quoted"))
    if r.peek()[1] != "=":
        return name, None
    r.take()
    return name, int(r.take("number"))


def _json_path(r: _Reader) -> tuple[str, ColType] | None:
    name = r.take().strip("`")
    if r.peek()[1] == "=":  # a limit, which has no meaning here
        r.take()
        r.take("number")
        return None
    if name == "SKIP":
        r.take()
        return None
    return name, _type(r)


@functools.lru_cache(maxsize=4096)
def parse(text: str) -> ColType:
    r = _Reader(_tokens(text))
    out = _type(r)
    if r.peek()[0] != "end":
        raise TypeError_(f"unread: {r.peek()[1]}")
    return out


def spark_type(t: ColType | str) -> T.DataType:
    """The Spark type of a column type's values; wide integers and long decimals that don't fit Spark's are text."""
    t = parse(t) if isinstance(t, str) else t
    inner = [spark_type(a) for a in t.args]
    if t.name in INT_BITS:
        bits, signed = INT_BITS[t.name]
        if bits > 64:
            return T.StringType()
        return {(8, True): T.ByteType(), (8, False): T.ShortType(), (16, True): T.ShortType(), (16, False): T.IntegerType(), (32, True): T.IntegerType(), (32, False): T.LongType(), (64, True): T.LongType(), (64, False): T.DecimalType(20, 0)}[bits, signed]
    match t.name:
        case "Float32":
            return T.FloatType()
        case "Float64":
            return T.DoubleType()
        case "Bool":
            return T.BooleanType()
        case "FixedString":
            return T.BinaryType()
        case "Date" | "Date32":
            return T.DateType()
        case "DateTime":
            return T.TimestampNTZType()
        case "DateTime64":
            return T.TimestampNTZType() if t.numbers[0] <= 6 else T.LongType()
        case "Decimal":
            return T.DecimalType(*t.numbers) if t.numbers[0] <= 38 else T.StringType()
        case "Nullable" | "LowCardinality":
            return inner[0]
        case "Array":
            return T.ArrayType(inner[0], t.args[0].is_nullable)
        case "Map":
            return T.MapType(inner[0], inner[1], t.args[1].is_nullable)
        case "Tuple":
            return T.StructType([T.StructField(n or f"_{i}", x) for i, (n, x) in enumerate(zip(t.names, inner, strict=True), 1)])
        case "Nested":
            return T.ArrayType(T.StructType([T.StructField(n, x) for n, x in zip(t.names, inner, strict=True)]))
        case "Variant":
            return T.StructType([T.StructField("d", T.ByteType()), *(T.StructField(f"v{i}", x) for i, x in enumerate(inner))])
        case "Dynamic":
            return T.VariantType()
        case "JSON":
            return T.StructType([*(T.StructField(n, x) for n, x in zip(t.names, inner, strict=True)), T.StructField("rest", T.VariantType())]) if t.args else T.VariantType()
        case "Point":
            return T.StructType([T.StructField("_1", T.DoubleType()), T.StructField("_2", T.DoubleType())])
        case "Ring" | "Polygon" | "MultiPolygon":
            out: T.DataType = spark_type("Point")
            for _ in range(("Ring", "Polygon", "MultiPolygon").index(t.name) + 1):
                out = T.ArrayType(out)
            return out
    return T.StringType()  # String, UUID, IPv4, IPv6, enums by name


def structure(text: str) -> list[tuple[str, ColType]]:
    """A structure string, e.g. "id UInt32, name String", as names and types."""
    r = _Reader(_tokens(text))
    out = [(r.take().strip("`"), _type(r))] if r.tokens else []
    while r.peek()[1] == ",":
        r.take()
        out.append((r.take().strip("`"), _type(r)))
    if r.peek()[0] != "end":
        raise TypeError_(f"unread: {r.peek()[1]}")
    return out


def schema(columns: list[tuple[str, ColType | str]]) -> T.StructType:
    """The Spark schema, each field with its type string as metadata."""
    parsed = [(n, parse(t) if isinstance(t, str) else t) for n, t in columns]
    return T.StructType([T.StructField(n, spark_type(t), True, {"src_type": str(t)}) for n, t in parsed])
