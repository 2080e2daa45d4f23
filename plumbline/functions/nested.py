"""Nested and tagged values: tagged unions, inferred types, JSON paths, dictionaries, sparse columns, canonical hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window


def tagged(alternatives: list[tuple[Column, Column]], types: list[str]) -> Column:
    """A tagged union from (condition, value) pairs in order of declaration: the first condition that holds gives the tag."""
    tag = F.lit(None).cast("byte")
    for i, (condition, _) in reversed(list(enumerate(alternatives))):
        tag = F.when(condition, F.lit(i).cast("byte")).otherwise(tag)
    return F.struct(tag.alias("d"), *(F.when(tag == i, value).cast(t).alias(f"v{i}") for i, ((_, value), t) in enumerate(zip(alternatives, types, strict=True))))


def tag_value(union: Column, i: int) -> Column:
    return F.when(union["d"] == i, union[f"v{i}"])


def index_in_group(df: DataFrame, group: str, order: str, name: str = "idx") -> DataFrame:
    """Each row's place among the rows of its group, from 0."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1)


def json_paths(df: DataFrame, column: str) -> DataFrame:
    """The distinct top-level paths of a JSON text column, sorted."""
    return df.select(F.explode(F.json_object_keys(column)).alias("path")).distinct().orderBy("path")


def json_path(column: Column, path: str, to: str) -> Column:
    """A path's value as a type; null where it is missing or doesn't fit."""
    return F.try_variant_get(F.try_parse_json(column), path, to)


#: Bytes of distinct values up to which a dictionary is broadcast.
DICTIONARY_BYTES = 8 << 20


def row_numbers(df: DataFrame, order: list[str], name: str = "row") -> DataFrame:
    """df with dense numbers from 0 in an order, without a window over all rows: sorted in parallel, then counted."""
    from pyspark.sql import types as T

    out = T.StructType([*df.schema.fields, T.StructField(name, T.LongType(), False)])
    numbered = df.orderBy(*order).rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    return df.sparkSession.createDataFrame(numbered, out)


def dictionary_encode(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The distinct values with dense codes in their order, and df with a code in the column's place; null has the code null."""
    coded = row_numbers(df.select(column).filter(F.col(column).isNotNull()).distinct(), [column], "code")
    size = coded.agg(F.sum(F.octet_length(F.col(column).cast("string")) + 16).alias("n")).first()["n"] or 0
    return coded, df.join(F.broadcast(coded) if size <= DICTIONARY_BYTES else coded, column, "left").drop(column)


def densify(sparse: DataFrame, n: int, default: Column) -> DataFrame:
    """(idx, value) rows as n rows, the missing ones with the default."""
    full = sparse.sparkSession.range(n).withColumnRenamed("id", "idx")
    return full.join(sparse, "idx", "left").select("idx", F.coalesce("value", default).alias("value"))


def flatten(df: DataFrame, column: str) -> DataFrame:
    """A row for each element, with its place; an empty array is one row at place -1, a null one at place null."""
    rest = [c for c in df.columns if c != column]
    rows = df.select(*rest, F.size(column).alias("_n"), F.posexplode_outer(column).alias("pos", "value"))
    return rows.withColumn("pos", F.when((F.col("_n") == 0) & F.col("pos").isNull(), -1).otherwise(F.col("pos"))).drop("_n")


def unflatten(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The inverse of flatten(), where keys tell its rows apart."""
    pairs = F.sort_array(F.collect_list(F.when(F.col("pos") >= 0, F.struct("pos", "value"))))
    return df.groupBy(*keys).agg(F.when(F.max("pos").isNotNull(), F.transform(pairs, lambda p: p["value"])).alias(name))


def canonical(c: Column, t: T.DataType) -> Column:
    """A form that can be hashed and compared: maps as sorted entries, variants as JSON text."""
    if isinstance(t, T.MapType):
        return F.array_sort(F.map_entries(c))
    if isinstance(t, T.VariantType):
        return F.to_json(c)
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: canonical(x, t.elementType))
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(canonical(c[f.name], f.dataType).alias(f.name) for f in t.fields)))
    return c


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*(canonical(F.col(f.name), f.dataType) for f in df.schema.fields))


def fingerprint(df: DataFrame) -> Column:
    """One number for a table's rows, whatever their order."""
    return F.sum(row_hash(df).cast("decimal(38,0)"))


def differences(a: DataFrame, b: DataFrame) -> tuple[int, int]:
    """Rows of a that b hasn't, and the other way round, by canonical hash."""
    x, y = a.select(row_hash(a).alias("h")), b.select(row_hash(b).alias("h"))
    return x.exceptAll(y).count(), y.exceptAll(x).count()


def differing_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """The columns whose values, as multisets, aren't the same in a and b; and those that only one of them has."""
    out = [c for c in [*a.columns, *b.columns] if c not in a.columns or c not in b.columns]
    for f in a.schema.fields:
        if f.name in b.columns:
            x, y = (t.select(F.xxhash64(canonical(F.col(f.name), f.dataType)).alias("h")) for t in (a, b))
            if not x.exceptAll(y).isEmpty() or not y.exceptAll(x).isEmpty():
                out.append(f.name)
    return out


#: Whole numbers by the bits that they need, for the type that holds several.
_RANK = ["Int8", "Int16", "Int32", "Int64", "Int128", "Int256"]


def common_type(kinds: list[str]) -> str:
    """The type that holds the values of several: the widest number, a nullable one if any is, or a variant of them all."""
    from .types import INT_BITS, parse

    types = [parse(k) for k in kinds]
    nullable, plain = any(t.name == "Nullable" for t in types), list(dict.fromkeys(str(t.args[0] if t.name == "Nullable" else t) for t in types))
    if len(plain) == 1:
        out = plain[0]
    elif all(p in INT_BITS for p in plain):
        bits = [INT_BITS[p] for p in plain]
        if all(not signed for _, signed in bits):
            out = f"UInt{max(b for b, _ in bits)}"
        else:
            need = max(b if signed else 2 * b for b, signed in bits)
            out = next((r for r in _RANK if INT_BITS[r][0] >= need), "Int256")
    elif all(p in INT_BITS or p.startswith("Float") for p in plain):
        out = "Float64"
    else:
        return f"Variant({', '.join(sorted(plain))})"
    return f"Nullable({out})" if nullable else out
