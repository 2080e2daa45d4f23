"""Strict coercion of text or loosely typed columns to column types, as expressions.

A null in a column that isn't nullable becomes the type's default; a value that doesn't fit raises. Decimals are cut,
not rounded; dates and seconds go down, sub-millisecond instants toward zero.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from .types import INT_BITS, ColType, parse, spark_type

IPV4 = r"^(25[0-5]|2[0-4]\d|1?\d?\d)(\.(25[0-5]|2[0-4]\d|1?\d?\d)){3}$"
#: Fixed value: what a decimal's text looks like.
DECIMAL = r"^-?\d+(\.\d+)?$"
NIL = "00000000-0000-0000-0000-000000000000"


def _fail(what: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"Cannot convert to {what}: "), F.coalesce(value.cast("string"), F.lit("null"))))


def _checked(ok: Column, value: Column, what: str, original: Column) -> Column:
    return F.when(ok, value).otherwise(_fail(what, original))


def to_float(c: Column, to: str = "double") -> Column:
    """Numbers, truth values and numeric text, with white space around it; empty text raises."""
    text = F.trim(c.cast("string"))
    return F.coalesce(F.when(text == "true", "1").when(text == "false", "0").otherwise(text).cast(to), F.lit(0).cast(to))


def to_int(c: Column, name: str) -> Column:
    """A whole number in the range of the type; beyond 64 bits as decimal text."""
    bits, signed = INT_BITS[name]
    low, high = (-(1 << bits - 1), (1 << bits - 1) - 1) if signed else (0, (1 << bits) - 1)
    text = F.trim(F.when(c.cast("string") == "true", "1").when(c.cast("string") == "false", "0").otherwise(c.cast("string")))
    if bits <= 64:
        number = text.cast("decimal(38,18)") if bits < 64 else text.cast("decimal(38,6)")
        ok = (number == F.floor(number)) & number.between(F.lit(str(low)).cast("decimal(38,0)"), F.lit(str(high)).cast("decimal(38,0)"))
        return F.when(c.isNull(), F.lit(0)).otherwise(_checked(ok, number, name, c)).cast(spark_type(name))
    # Compared as text: by sign, then length, then digits.
    digits = F.regexp_replace(F.regexp_replace(text, r"^[-+]", ""), r"^0+(?=\d)", "")
    negative = text.startswith("-") & (digits != "0")
    bound = F.when(negative, str(-low)).otherwise(str(high))
    fits = (F.length(digits) < F.length(bound)) | ((F.length(digits) == F.length(bound)) & (digits <= bound))
    ok = text.rlike(r"^[-+]?\d+$") & fits & (F.lit(signed) | ~negative)
    return F.when(c.isNull(), "0").otherwise(_checked(ok, F.concat(F.when(negative, "-").otherwise(""), digits), name, c))


def to_bool(c: Column) -> Column:
    text = F.lower(c.cast("string"))
    number = text.rlike(DECIMAL)
    return F.when(c.isNull(), False).when(text.isin("true", "1"), True).when(text.isin("false", "0"), False).when(number, F.try_to_number(text, F.lit("999999999999999999")).isNotNull()).otherwise(_fail("Bool", c).cast("boolean"))


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    """Digits beyond the scale are cut off. Above 38 digits the result is text with exactly scale digits."""
    text = F.trim(c.cast("string"))
    whole = F.regexp_extract(text, r"^(-?\d+)", 1)
    part = F.rpad(F.regexp_extract(text, r"\.(\d+)$", 1), scale, "0") if scale else F.lit("")
    cut = F.concat(whole, F.lit("."), part) if scale else whole
    cut = F.when(text.rlike(DECIMAL), cut).otherwise(_fail("Decimal", c))
    zero = "0." + "0" * scale if scale else "0"
    out = F.when(c.isNull(), zero).otherwise(cut)
    return out.cast(f"decimal({precision},{scale})") if precision <= 38 else out


def to_text(c: Column, of: T.DataType | None = None) -> Column:
    if isinstance(of, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.to_json(c), F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def to_uuid(c: Column) -> Column:
    bare = F.lower(F.regexp_replace(c.cast("string"), "-", ""))
    dashed = F.concat_ws("-", *(F.substring(bare, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    return F.when(c.isNull(), NIL).otherwise(_checked((F.length(bare) == 32) & ~bare.rlike("[^0-9a-f]") & c.cast("string").rlike("^[^-]{8}-?[^-]+-?[^-]+-?[^-]+-?[^-]{12}$"), dashed, "UUID", c))


def to_ipv4(c: Column) -> Column:
    return F.when(c.isNull(), "0.0.0.0").otherwise(_checked(c.cast("string").rlike(IPV4), c.cast("string"), "IPv4", c))


def ipv4_number(c: Column) -> Column:
    """The address as an unsigned 32-bit number."""
    parts = F.split(c, r"\.")
    return sum((parts[i].cast("long") * (1 << 8 * (3 - i)) for i in range(1, 4)), parts[0].cast("long") * (1 << 24))


def to_ipv6(c: Column) -> Column:
    """Eight groups of four lower-case hex digits."""
    text = F.lower(c.cast("string"))
    # Each :: stands for as many groups of 0 as are missing.
    sides = F.split(text, "::", 2)
    groups = lambda s: F.filter(F.split(s, ":"), lambda g: g != "")
    head, tail = groups(sides[0]), F.when(F.size(sides) > 1, groups(F.get(sides, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    missing = F.lit(8) - F.size(head) - F.size(tail)
    full = F.concat(head, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0)).cast("int")), tail)
    out = F.array_join(F.transform(full, lambda g: F.lpad(g, 4, "0")), ":")
    valid = text.rlike(r"^[0-9a-f:]*$") & (F.size(F.split(text, "::")) <= 2) & ~text.rlike(":::") & ~text.rlike(r"(^:[^:])|([^:]:$)")
    valid = valid & F.forall(full, lambda g: F.length(g) <= 4) & (F.size(full) == 8) & ((F.size(sides) > 1) == (missing > 0))
    return F.when(c.isNull(), ":".join(["0000"] * 8)).otherwise(_checked(valid, out, "IPv6", c))


def to_enum(c: Column, t: ColType) -> Column:
    """A name, or the number of one; null becomes the name of the least value."""
    names = [n for n, _ in t.labels]
    by_number = F.create_map(*(F.lit(x) for n, v in t.labels for x in (str(v), n)))
    text = c.cast("string")
    least = min(t.labels, key=lambda x: x[1])[0]
    return F.when(c.isNull(), least).when(text.isin(names), text).otherwise(F.coalesce(F.try_element_at(by_number, text), _fail(t.name, c)))


def to_fixed(c: Column, n: int) -> Column:
    raw = F.when(c.isNull(), F.encode(F.lit(""), "UTF-8")).otherwise(c.cast("binary"))
    return _checked(F.octet_length(raw) <= n, F.rpad(raw, n, b"\0"), f"FixedString({n})", F.hex(raw)).cast("binary")


def to_date(c: Column, name: str) -> Column:
    day = F.coalesce(c.cast("date"), F.lit("1970-01-01").cast("date"))
    days = F.unix_date(day)
    return _checked(days.between(0, 65535), day, name, c) if name == "Date" else day


def to_timestamp(c: Column, precision: int = 0, ranged: bool = True) -> Column:
    """Whole seconds for precision 0; up to 6 digits a timestamp; 7 to 9 digits ticks since 1970."""
    at = F.coalesce(c.cast("timestamp"), F.lit("1970-01-01 00:00:00").cast("timestamp"))
    micros = F.unix_micros(at)
    if precision > 6:
        # Spark's timestamps end at microseconds: the digits after are read from the text.
        more = F.rpad(F.regexp_extract(c.cast("string"), r"\.\d{6}(\d{1,3})", 1), 3, "0").cast("long")
        return micros * 10 ** (precision - 6) + F.when(c.isNull(), 0).otherwise(F.floor(more / 10 ** (9 - precision)))
    if ranged:
        seconds = F.floor(micros / 1_000_000)
        return F.timestamp_seconds(_checked(seconds.between(0, (1 << 32) - 1), seconds, "DateTime", c)).cast("timestamp_ntz")
    step = 10 ** (6 - precision)
    toward_zero = F.when(micros >= 0, micros - micros % step).otherwise(micros - micros % step)
    return F.timestamp_micros(toward_zero).cast("timestamp_ntz")


def ticks_to_timestamp(ticks: Column, precision: int, closest: bool = False) -> Column:
    """Ticks of 10**-precision seconds as a timestamp; digits below a microsecond raise unless closest is asked for."""
    if precision <= 6:
        return F.timestamp_micros(ticks * 10 ** (6 - precision))
    step = 10 ** (precision - 6)
    micros = ((ticks - F.pmod(ticks, F.lit(step))).cast("decimal(20,0)") / F.lit(step).cast("decimal(5,0)")).cast("long")
    return F.timestamp_micros(micros if closest else _checked(ticks % step == 0, micros, "timestamp", ticks))


def coerce(c: Column, t: ColType | str, of: T.DataType | None = None) -> Column:
    """c as a value of column type t; of is c's Spark type, if it is known and nested."""
    t = parse(t) if isinstance(t, str) else t
    match t.name:
        case "Nullable":
            return F.when(c.isNull(), F.lit(None)).otherwise(coerce(c, t.args[0], of)).cast(spark_type(t))
        case "LowCardinality":
            return coerce(c, t.args[0], of)
        case "Float32" | "Float64":
            return to_float(c, "float" if t.name == "Float32" else "double")
        case "Bool":
            return to_bool(c)
        case "String":
            return to_text(c, of)
        case "FixedString":
            return to_fixed(c, t.numbers[0])
        case "UUID":
            return to_uuid(c)
        case "IPv4":
            return to_ipv4(c)
        case "IPv6":
            return to_ipv6(c)
        case "Enum8" | "Enum16":
            return to_enum(c, t)
        case "Decimal":
            return to_decimal(c, *t.numbers)
        case "Date" | "Date32":
            return to_date(c, t.name)
        case "DateTime":
            return to_timestamp(c)
        case "DateTime64":
            return to_timestamp(c, t.numbers[0], ranged=False)
        case "Array":
            inner = of.elementType if isinstance(of, T.ArrayType) else None
            return F.coalesce(F.transform(c, lambda x: coerce(x, t.args[0], inner)), F.array().cast(spark_type(t)))
        case "Map":
            kinds = (of.keyType, of.valueType) if isinstance(of, T.MapType) else (None, None)
            values = F.transform_values(c, lambda k, v: coerce(v, t.args[1], kinds[1]).cast(spark_type(t.args[1])))
            return F.coalesce(F.transform_keys(values, lambda k, v: coerce(k, t.args[0], kinds[0]).cast(spark_type(t.args[0]))), F.create_map().cast(spark_type(t)))
        case "Tuple":
            fields = of.fields if isinstance(of, T.StructType) else [None] * len(t.args)
            made = [coerce(c.getField(f.name) if f is not None else c.getField(n or f"_{i}"), a, f.dataType if f is not None else None).cast(spark_type(a)).alias(n or f"_{i}") for i, (n, a, f) in enumerate(zip(t.names, t.args, fields, strict=False), 1)]
            return F.struct(*made)
        case "Nested":
            inner = of.elementType if isinstance(of, T.ArrayType) else None
            row = ColType("Tuple", t.args, t.names)
            return F.coalesce(F.transform(c, lambda x: coerce(x, row, inner)), F.array().cast(spark_type(t)))
        case "Point":
            return F.coalesce(c.cast(spark_type(t)), F.struct(F.lit(0.0).alias("_1"), F.lit(0.0).alias("_2")))
        case "Ring" | "Polygon" | "MultiPolygon":
            return F.coalesce(c.cast(spark_type(t)), F.array().cast(spark_type(t)))
        case "Dynamic":
            # Text of JSON has its own type, and other text is text.
            return F.to_variant_object(c) if isinstance(of, (T.StructType, T.ArrayType, T.MapType)) else F.coalesce(F.try_parse_json(c.cast("string")), c.cast("variant"))
        case "JSON" if not t.args:
            return F.parse_json(c)
    if t.name in INT_BITS:
        return to_int(c, t.name)
    return c.cast(spark_type(t))


def default(t: ColType | str) -> Column:
    """What null becomes in a column that isn't nullable."""
    t = parse(t) if isinstance(t, str) else t
    return F.lit(None).cast(spark_type(t)) if t.is_nullable else coerce(F.lit(None).cast(T.StringType() if t.name not in ("Array", "Map", "Tuple") else spark_type(t)), t)
