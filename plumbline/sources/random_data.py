"""Random tables of a structure, and random structures; the same seed gives the same rows."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.types import INT_BITS, ColType, spark_type, structure

_SCALARS = ["Int8", "UInt8", "Int16", "UInt16", "Int32", "UInt32", "Int64", "UInt64", "Float32", "Float64", "Bool", "String", "FixedString(6)", "Date", "DateTime", "DateTime64(3)", "UUID", "IPv4", "Decimal(12, 3)", "Enum8('a' = 1, 'b' = 2)"]


class _Draws:
    """Independent numbers for each place of a row: hashes of the row's number, the seed and the place."""

    def __init__(self, row: Column, seed: int):
        self.row, self.seed, self.n = row, seed, 0

    def bits(self, *more: Column) -> Column:
        self.n += 1
        return F.xxhash64(self.row, F.lit(self.seed), F.lit(self.n), *more)

    def below(self, n: int, *more: Column) -> Column:
        return F.pmod(self.bits(*more), F.lit(n))


def _value(t: ColType, d: _Draws, *more: Column) -> Column:
    if t.name in INT_BITS:
        bits, signed = INT_BITS[t.name]
        if bits > 64:
            return F.abs(F.shiftright(d.bits(*more), 1)).cast("string")
        if bits == 64 and not signed:
            return d.bits(*more).cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
        return (d.bits(*more) if bits == 64 else d.below(1 << bits, *more) - ((1 << bits - 1) if signed else 0)).cast(spark_type(t))
    match t.name:
        case "Nullable":
            return F.when(d.below(10, *more) >= 3, _value(t.args[0], d, *more))
        case "LowCardinality":
            return F.concat(F.lit("v"), d.below(16, *more).cast("string")) if t.args[0].unwrapped().name == "String" else _value(t.args[0], d, *more)
        case "Float32" | "Float64":
            return (d.below(1 << 40, *more) / F.lit(1 << 20) - F.lit(1 << 19)).cast(spark_type(t))
        case "Bool":
            return d.below(2, *more) == 1
        case "String":
            text = F.concat(F.md5(d.bits(*more).cast("string")), F.lit(" é\t"), d.bits(*more).cast("string"))
            return F.substring(text, F.lit(1), d.below(40, *more).cast("int"))
        case "FixedString":
            return F.substring(F.encode(F.repeat(F.md5(d.bits(*more).cast("string")), -(-t.numbers[0] // 32)), "UTF-8"), 1, t.numbers[0])
        case "Date" | "Date32":
            return F.date_from_unix_date(d.below(65_536, *more).cast("int"))
        case "DateTime":
            return F.timestamp_seconds(d.below(1 << 32, *more)).cast("timestamp_ntz")
        case "DateTime64":
            ticks = d.below(4_000_000_000 * 10 ** min(6, t.numbers[0]), *more)
            return F.timestamp_micros(ticks * 10 ** (6 - t.numbers[0])).cast("timestamp_ntz") if t.numbers[0] <= 6 else ticks
        case "UUID":
            h = F.md5(d.bits(*more).cast("string"))
            return F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
        case "IPv4":
            return F.concat_ws(".", *(d.below(256, *more).cast("string") for _ in range(4)))
        case "IPv6":
            h = F.md5(d.bits(*more).cast("string"))
            return F.concat_ws(":", *(F.substring(h, 1 + 4 * i, 4) for i in range(8)))
        case "Decimal":
            n = min(t.numbers[0], 18)
            return (d.below(10**n, *more).cast("decimal(38,0)") / F.lit(10 ** t.numbers[1]).cast("decimal(38,0)")).cast(spark_type(t))
        case "Enum8" | "Enum16":
            return F.element_at(F.array(*(F.lit(x) for x, _ in t.labels)), (d.below(len(t.labels), *more) + 1).cast("int"))
        case "Array":
            place = F.sequence(F.lit(0).cast("long"), d.below(6, *more))
            return F.transform(F.slice(place, 2, 5), lambda i: _value(t.args[0], d, i, *more))
        case "Map":
            place = F.slice(F.sequence(F.lit(0).cast("long"), d.below(5, *more)), 2, 5)
            return F.map_from_entries(F.array_distinct(F.transform(place, lambda i: F.struct(F.concat(F.lit("k"), i.cast("string")).cast(spark_type(t.args[0])).alias("key"), _value(t.args[1], d, i, *more).alias("value")))))
        case "Tuple":
            return F.struct(*(_value(a, d, *more).alias(n or f"_{i}") for i, (n, a) in enumerate(zip(t.names, t.args, strict=True), 1)))
    raise ValueError(f"no random values of type {t}")


def random_table(spark: SparkSession, text: str, rows: int, seed: int = 1) -> DataFrame:
    """rows of a structure, e.g. "id UInt32, tags Array(String)"; made in parallel, by expressions alone."""
    columns, d = structure(text), _Draws(F.col("_row"), seed)
    return spark.range(rows).withColumnRenamed("id", "_row").select(*(_value(t, d).alias(n, metadata={"src_type": str(t)}) for n, t in columns))


def random_structure(columns: int | None = None, seed: int = 1, depth: int = 2) -> str:
    """A structure string of so many columns, 1 to 16 if not given."""
    rng = random.Random(seed)

    def kind(depth: int) -> str:
        what = rng.random() if depth else 1.0
        if what < 0.15:
            return f"Nullable({rng.choice(_SCALARS)})"
        if what < 0.3:
            return f"Array({kind(depth - 1)})"
        if what < 0.4:
            return f"Map(String, {kind(depth - 1)})"
        if what < 0.5:
            return f"Tuple({kind(depth - 1)}, {kind(depth - 1)})"
        return "LowCardinality(String)" if what < 0.55 else rng.choice(_SCALARS)

    return ", ".join(f"c{i} {kind(depth)}" for i in range(1, (columns or rng.randint(1, 16)) + 1))
