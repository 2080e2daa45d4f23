"""Text formats as sources and sinks: JSON lines, CSV, tab-separated, and files of columns."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.coerce import coerce
from ..functions.types import ColType, spark_type

#: Names of formats, and Spark's options for each.
CSV = {"CSV": {"sep": ","}, "CSVWithNames": {"sep": ",", "header": "true"}, "TabSeparated": {"sep": "\t", "quote": ""}, "TSV": {"sep": "\t", "quote": ""}, "TabSeparatedWithNames": {"sep": "\t", "quote": "", "header": "true"}}
JSON = {"JSONEachRow", "JSONLines", "NDJSON", "JSONStringsEachRow"}


def _coerced(rows: DataFrame, columns: list[tuple[str, ColType]]) -> DataFrame:
    return rows.select([coerce(F.col(n), t, rows.schema[n].dataType).alias(n, metadata={"src_type": str(t)}) for n, t in columns])


def _text_schema(columns: list[tuple[str, ColType]], nested: bool) -> T.StructType:
    from ..functions.types import spark_type

    keep = lambda t: nested and t.unwrapped().name in ("Array", "Map", "Tuple", "Nested")
    return T.StructType([T.StructField(n, spark_type(t) if keep(t) else T.StringType()) for n, t in columns])


def parse_text(spark: SparkSession, data: bytes | str, format: str, columns: list[tuple[str, ColType]]) -> DataFrame:
    """Data in memory; values are read as text and coerced strictly, so none becomes null by being out of range."""
    text = data.decode() if isinstance(data, bytes) else data
    if format in JSON:
        raw = spark.createDataFrame([(x,) for x in text.split("\n") if x.strip()], "value string")
        return _coerced(raw.select(F.from_json("value", _text_schema(columns, True), {"mode": "FAILFAST"}).alias("r")).select("r.*"), columns)
    if format not in CSV:
        raise ValueError(f"format {format} isn't known")
    if CSV[format]["sep"] == "\t":
        lines = [x.rstrip("\r") for x in text.split("\n")]
        rows = [[None if v == "\\N" else unescape(v) for v in x.split("\t")] for x in (lines[:-1] if lines[-1] == "" else lines)]
    else:
        # A quoted value may hold line ends and separators; one that isn't quoted is null if it says \N.
        rows = [[None if v == "\\N" else v for v in x] for x in csv.reader(io.StringIO(text, newline=""), strict=True) if x]
    rows = rows[1:] if "header" in CSV[format] else rows
    for i, row in enumerate(rows):
        if len(row) != len(columns):
            raise ValueError(f"row {i} has {len(row)} values, expected {len(columns)}")
    nested = {n: spark_type(t) for n, t in columns if t.unwrapped().name in ("Array", "Map", "Tuple", "Nested")}
    raw = spark.createDataFrame([tuple(r) for r in rows], T.StructType([T.StructField(n, T.StringType()) for n, _ in columns]))
    return _coerced(raw.select([F.from_json(n, nested[n], {"mode": "FAILFAST"}).alias(n) if n in nested else F.col(n) for n, _ in columns]), columns)


_ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f", "0": "\0"}


def unescape(value: str) -> str:
    """The text of a tab-separated value: each backslash and what follows it are read together, from left to right."""
    return re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value, flags=re.S)


def _escaped(c):
    for a, b in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _unescaped(c):
    """unescape() of a column: a double backslash is set aside while the others are read."""
    c = F.replace(c, F.lit("\\\\"), F.lit("\0"))
    for a, b in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.replace(c, F.lit("\0"), F.lit("\\"))


def read(spark: SparkSession, path: str, format: str, columns: list[tuple[str, ColType]]) -> DataFrame:
    """Files of a format, split and read in parallel."""
    if format in JSON:
        return _coerced(spark.read.schema(_text_schema(columns, True)).option("mode", "FAILFAST").json(path), columns)
    if format in CSV and CSV[format]["sep"] == "\t":
        lines = spark.read.option("lineSep", "\n").text(path)
        if "header" in CSV[format]:
            lines = lines.filter(F.col("value") != "\t".join(n for n, _ in columns))
        parts = F.split("value", "\t", -1)
        return _coerced(lines.select(*(F.when(parts[i] != "\\N", _unescaped(parts[i])).alias(n) for i, (n, _) in enumerate(columns))), columns)
    if format in CSV:
        return _coerced(spark.read.option("multiLine", True).option("escape", '"').schema(_text_schema(columns, False)).options(**CSV[format]).csv(path), columns)
    return spark.read.format(format.lower()).load(path)


def write(df: DataFrame, format: str, path: str) -> None:
    if format == "Null":
        df.write.format("noop").mode("overwrite").save()
    elif format == "JSONStringsEachRow":
        df.select([F.col(c).cast("string").alias(c) for c in df.columns]).write.option("ignoreNullFields", "false").json(path)
    elif format in JSON:
        df.write.json(path)
    elif format in CSV and CSV[format]["sep"] == "\t":
        text = [F.coalesce(_escaped(F.to_json(f.name) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else F.col(f.name).cast("string")), F.lit("\\N")) for f in df.schema.fields]
        rows = df.select(F.array_join(F.array(*text), "\t").alias("value"))
        if "header" in CSV[format]:
            head = df.sparkSession.createDataFrame([("\t".join(df.columns),)], "value string")
            rows = head.unionByName(rows)
        rows.write.text(path)
    elif format in CSV:
        options = {**CSV[format], "nullValue": "\\N", "escape": '"'}
        df.select([F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else F.col(f.name) for f in df.schema.fields]).write.options(**options).csv(path)
    else:
        df.write.format(format.lower()).save(path)


def lines(spark: SparkSession, path: str, separator: str = "\n") -> DataFrame:
    return spark.read.option("lineSep", separator).text(path)


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("wholetext", True).text(path)


def json_lines(df: DataFrame) -> Iterator[str]:
    """Rows as JSON lines, a partition at a time."""
    for r in df.select(F.to_json(F.struct(*df.columns)).alias("j")).toLocalIterator():
        yield r["j"]
