"""Queries with typed parameters, external tables and settings; typed inserts; results with side results and metrics.

Each query runs in a session of its own, so that its temporary views and settings end with it.
"""

from __future__ import annotations

import json
import logging
import threading
import time
import uuid
import warnings
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F, types as T

from .functions import coerce as C
from .functions.types import ColType, parse, schema as make_schema, structure
from .plans.clauses import grand_total
from .plans.shim import Rewritten, rewrite
from .sources import formats

#: Settings that have a counterpart in Spark. Others are accepted, and said to have no effect.
SETTINGS = {
    "session_timezone": "spark.sql.session.timeZone", "max_threads": "spark.sql.shuffle.partitions", "max_block_size": "spark.sql.execution.arrow.maxRecordsPerBatch",
    "join_runtime_bloom_filter_bytes": "spark.sql.optimizer.runtime.bloomFilter.maxNumBits",
}
#: What a setting's value is multiplied by in Spark's unit.
UNITS = {"join_runtime_bloom_filter_bytes": 8}
OWN_SETTINGS = {"extremes", "totals_mode", "union_default_mode", "except_default_mode", "intersect_default_mode", "limit", "offset", "max_execution_time", "max_result_rows", "result_overflow_mode", "max_rows_to_read", "transform_null_in"}


log = logging.getLogger("plumbline")


class QueryError(Exception):
    """A failed query: Spark's condition and state beside the message."""

    def __init__(self, error: Exception, query_id: str):
        self.condition = error.getCondition() if isinstance(error, PySparkException) else type(error).__name__
        self.state = error.getSqlState() if isinstance(error, PySparkException) else None
        self.query_id = query_id
        super().__init__(f"{self.condition}: {error}")


class SchemaMismatch(ValueError):
    pass


@dataclass
class Progress:
    """Sums of what the query's stages have done so far."""

    read_rows: int = 0
    result_rows: int = 0
    elapsed_s: float = 0.0
    tasks: int = 0
    tasks_done: int = 0
    read_bytes: int = 0

    @property
    def percent(self) -> int:
        total = max(self.tasks, self.tasks_done)
        return 100 * self.tasks_done // total if total else 0


@dataclass
class QueryResult:
    """A query's rows, and beside them: totals, extremes, and after a run, progress. All are lazy."""

    data: DataFrame
    spark: SparkSession
    query_id: str
    plan: Rewritten
    settings: dict[str, Any] = field(default_factory=dict)
    totals: DataFrame | None = None
    before_limit: DataFrame | None = None
    timeout_s: float | None = None
    progress: Progress = field(default_factory=Progress)

    @property
    def columns(self) -> list[str]:
        return self.data.columns

    @cached_property
    def extremes(self) -> DataFrame:
        """Two rows: the least and the greatest value of each column."""
        rows = [self.data.agg(*(f(c).alias(c) for c in self.data.columns)).withColumn("extreme", F.lit(n)) for n, f in (("min", F.min), ("max", F.max))]
        return rows[0].unionByName(rows[1])

    def rows_before_limit(self) -> int | None:
        """Counted by a plan of its own: a limit ends the counted one early."""
        return self.before_limit.count() if self.before_limit is not None else None

    def collect(self) -> list[Row]:
        return self._run(self.data.collect)

    def to_arrow(self):
        return self._run(self.data.toArrow)

    def objects(self, big_as_text: bool = False) -> list[dict[str, Any]]:
        return [_plain(r.asDict(recursive=True), big_as_text) for r in self.collect()]

    def batches(self) -> Iterator[Any]:
        """Arrow batches, a partition at a time, under the query's tag and time limit; leaving early ends the query."""
        import pyarrow as pa

        schema = self.to_arrow_schema()
        # The thread that runs its jobs takes the tag over from the one that starts it.
        parts, ended = _chunks(self._run(self.data.toLocalIterator), 10_000), False
        try:
            while not ended:
                part = self._run(lambda: next(parts, None))
                ended = part is None
                if not ended:
                    yield pa.RecordBatch.from_pylist([r.asDict(recursive=True) for r in part], schema)
        finally:
            self.cancel()

    def to_arrow_schema(self):
        from pyspark.sql.pandas.types import to_arrow_schema

        return to_arrow_schema(self.data.schema)

    def column(self, name: str) -> list[Any]:
        """One column's values."""
        return [r[0] for r in self._run(self.data.select(name).collect)]

    def at(self, row: int, name: str) -> Any:
        """A value by its row's place and its column."""
        found = self._run(self.data.select(name).offset(row).limit(1).collect)
        if not found:
            raise IndexError(row)
        return found[0][0]

    def write(self, format: str, path: str) -> None:
        self._run(lambda: formats.write(self.data, format, path))

    def cancel(self) -> None:
        self.spark.sparkContext.cancelJobsWithTag(self.query_id)

    def _run(self, action):
        sc, began, timer, most = self.spark.sparkContext, time.time(), None, int(self.settings.get("max_rows_to_read") or 0)
        if self.timeout_s:
            timer = threading.Timer(self.timeout_s, self.cancel)
            timer.start()
        ended = threading.Event()
        if most:
            threading.Thread(target=self._guard, args=(most, ended), daemon=True).start()
        sc.addJobTag(self.query_id)
        failed = None
        try:
            out = action()
        except Exception as e:
            failed = e
        finally:
            ended.set()
            if timer:
                timer.cancel()
            sc.removeJobTag(self.query_id)
            self.progress.elapsed_s += time.time() - began
            if most:
                sc._jsc.sc().listenerBus().waitUntilEmpty()
            self.update_progress()
        if most and self.progress.read_rows > most:
            raise QueryError(OverflowError(f"more than {most} rows were read"), self.query_id) from failed
        if failed:
            raise QueryError(failed, self.query_id) from failed
        if isinstance(out, list):
            self.progress.result_rows += len(out)
        return out

    def _guard(self, most: int, ended: threading.Event) -> None:
        """Ends the query soon after it has read too many rows."""
        while not ended.wait(0.5):
            if self.update_progress().read_rows > most:
                self.cancel()
                return

    def update_progress(self) -> Progress:
        """Sums over the stages of the query's jobs so far, from Spark's own status store; it may be asked while a query runs."""
        p, jsc = self.progress, self.spark.sparkContext._jsc.sc()
        store, p.read_rows, p.read_bytes, p.tasks, p.tasks_done = jsc.statusStore(), 0, 0, 0, 0
        stages = {s for job in jsc.statusTracker().getJobIdsForTag(self.query_id) for s in _scala_list(store.job(job).stageIds())}
        for stage in stages:
            try:
                seen = store.lastStageAttempt(stage)
            except Exception:  # a stage that was skipped has no attempt
                continue
            p.read_rows += seen.inputRecords()
            p.read_bytes += seen.inputBytes()
            p.tasks += seen.numTasks()
            p.tasks_done += seen.numCompleteTasks()
        return p


def _scala_list(values) -> list[Any]:
    return [values.apply(i) for i in range(values.size())]


def parse_summary(text: str | None) -> Progress:
    """The progress in a summary of JSON text; zeros where there is none, or where it can't be read."""
    try:
        said = json.loads(text or "{}")
    except ValueError:
        said = {}
    said = said if isinstance(said, dict) else {}

    def number(name: str) -> int:
        try:
            return int(said.get(name, 0))
        except (TypeError, ValueError):
            return 0

    return Progress(number("read_rows"), number("result_rows"), number("elapsed_ns") / 1e9, read_bytes=number("read_bytes"))


def _chunks(rows: Iterator[Row], size: int) -> Iterator[list[Row]]:
    part: list[Row] = []
    for r in rows:
        part.append(r)
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part


def _plain(value: Any, big_as_text: bool) -> Any:
    if isinstance(value, dict):
        return {k: _plain(v, big_as_text) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v, big_as_text) for v in value]
    return str(value) if big_as_text and isinstance(value, int) and not isinstance(value, bool) and abs(value) >= 1 << 53 else value


@dataclass
class ExternalTable:
    """Raw data of a table for one query: a structure string and bytes or text in a format."""

    structure: str
    data: bytes | str
    format: str = "TabSeparated"


class Engine:
    def __init__(self, spark: SparkSession, settings: dict[str, Any] | None = None):
        self.spark, self.settings, self.functions = spark, settings or {}, {}

    def query(self, sql: str, params: dict[str, Any] | None = None, external_tables: dict[str, Any] | None = None, settings: dict[str, Any] | None = None, query_id: str | None = None, timeout_s: float | None = None) -> QueryResult:
        plan = rewrite(sql, {**self.settings, **(settings or {})})
        all_settings = {**self.settings, **(settings or {}), **plan.settings}
        log.debug("query %s: %s", query_id or "", plan.sql)
        session = self._session(all_settings)
        query_id = query_id or uuid.uuid4().hex
        missing = set(plan.parameters) - set(params or {})
        if missing:
            raise ValueError(f"no value for parameters: {', '.join(sorted(missing))}")
        try:
            for name, table in (external_tables or {}).items():
                in_session(as_table(session, table), session).createOrReplaceTempView(name)
            args = {k: params[k] for k in plan.parameters}
            data = session.sql(plan.sql, args=args) if args else session.sql(plan.sql)
            totals = None
            if plan.totals:
                data, totals = with_totals(session, plan.sql, args, str(all_settings.get("totals_mode", "after_having_exclusive")))
        except PySparkException as e:
            raise QueryError(e, query_id) from e
        before = data
        if "offset" in all_settings:
            data = data.offset(int(all_settings["offset"]))
        if "limit" in all_settings and int(all_settings["limit"]):
            data = data.limit(int(all_settings["limit"]))
        if "max_result_rows" in all_settings and int(all_settings["max_result_rows"]):
            most = int(all_settings["max_result_rows"])
            if all_settings.get("result_overflow_mode") == "break":
                data = data.limit(most)
            elif data.limit(most + 1).count() > most:
                raise QueryError(OverflowError(f"more than {most} rows"), query_id)
        seconds = timeout_s or (float(all_settings["max_execution_time"]) if "max_execution_time" in all_settings else None)
        return QueryResult(data, session, query_id, plan, all_settings, totals, before if data is not before else None, seconds)

    def _session(self, settings: dict[str, Any]) -> SparkSession:
        session = self.spark.newSession()
        session.conf.set("spark.sql.session.timeZone", "UTC")
        session.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        for name, function in self.functions.items():
            session.udf.register(name, function)
        for k, v in settings.items():
            if k in SETTINGS:
                session.conf.set(SETTINGS[k], str(int(v) * UNITS[k] if k in UNITS else v))
            elif k.startswith("spark."):
                session.conf.set(k, str(v))
            elif k not in OWN_SETTINGS:
                warnings.warn(f"setting {k} has no effect", stacklevel=3)
        return session

    def insert(self, table: str, data: DataFrame | Iterable[Any], schema: list[tuple[str, str]] | None = None, batch_size: int = 10_000) -> int:
        """Appends rows, and returns how many: a DataFrame, several of them, or objects, which are coerced to the table's types
        (schema: its column types, where Spark's don't say) batch by batch."""
        if isinstance(data, DataFrame):
            return self._insert_rows(table, data, schema)
        total, held = 0, []
        target = self.spark.table(table)
        columns = schema or [(f.name, f.metadata.get("src_type") or _own_type(f.dataType)) for f in target.schema.fields]
        for x in data:
            if isinstance(x, DataFrame):
                total += self._insert_rows(table, x, schema)
                continue
            held.append(x)
            if len(held) == batch_size:
                total += self._insert_rows(table, from_objects(self.spark, columns, held), None)
                held = []
        return total + (self._insert_rows(table, from_objects(self.spark, columns, held), None) if held else 0)

    def _insert_rows(self, table: str, rows: DataFrame, schema: list[tuple[str, str]] | None) -> int:
        target, seen = self.spark.table(table), Observation()
        if schema is not None:
            validate_schema(schema, [(f.name, f.metadata.get("src_type", "")) for f in rows.schema.fields])
        rows = rows.select([F.col(c).cast(target.schema[c].dataType).alias(c) for c in target.columns if c in rows.columns])
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n"))
        view = f"_insert_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        try:
            names = ", ".join(f"`{c}`" for c in rows.columns)
            self.spark.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)
        return int(seen.get.get("n", 0))

    def register(self, name: str, function, returns: str) -> None:
        """A function for queries of this engine: a column function of pandas series, called on Arrow batches."""
        self.functions[name] = F.pandas_udf(function, returns)

    def copy(self, source: str, target: str) -> None:
        self.spark.sql(f"INSERT INTO {target} SELECT * FROM {source}")

    def load_json_lines(self, path: str, table: str) -> None:
        """Loads a file of JSON lines into a table, by its schema."""
        from .functions.types import parse as parse_type

        target = self.spark.table(table)
        columns = [(f.name, parse_type(f.metadata.get("src_type") or _own_type(f.dataType))) for f in target.schema.fields]
        rows = formats.read(self.spark, path, "JSONEachRow", columns)
        rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]).write.insertInto(table)


def _own_type(t: T.DataType) -> str:
    names = {T.ByteType: "Int8", T.ShortType: "Int16", T.IntegerType: "Int32", T.LongType: "Int64", T.FloatType: "Float32", T.DoubleType: "Float64", T.BooleanType: "Bool", T.StringType: "String", T.DateType: "Date32", T.TimestampNTZType: "DateTime64(6)", T.TimestampType: "DateTime64(6)", T.VariantType: "Dynamic"}
    if isinstance(t, T.DecimalType):
        return f"Decimal({t.precision}, {t.scale})"
    if isinstance(t, T.ArrayType):
        return f"Array({_own_type(t.elementType)})"
    if isinstance(t, T.MapType):
        return f"Map({_own_type(t.keyType)}, {_own_type(t.valueType)})"
    if isinstance(t, T.StructType):
        return f"Tuple({', '.join(f'`{f.name}` {_own_type(f.dataType)}' for f in t.fields)})"
    return names.get(type(t), "String")


def validate_schema(expected: list[tuple[str, str]], actual: list[tuple[str, str]]) -> None:
    if len(expected) != len(actual):
        raise SchemaMismatch(f"Column count mismatch: expected {len(expected)}, got {len(actual)}")
    for i, ((n, t), (m, u)) in enumerate(zip(expected, actual, strict=True)):
        if n != m:
            raise SchemaMismatch(f"Column {i} name mismatch: expected {n!r}, got {m!r}")
        if str(parse(t)) != (str(parse(u)) if u else ""):
            raise SchemaMismatch(f"Column {n!r} type mismatch: expected {t}, got {u}")


def from_objects(spark: SparkSession, columns: list[tuple[str, str | ColType]], rows: Iterable[dict[str, Any]]) -> DataFrame:
    """Row objects by name: unknown keys are ignored, missing and null ones become the type's default."""
    parsed = [(n, parse(t) if isinstance(t, str) else t) for n, t in columns]
    rows = list(rows)
    if any(not isinstance(r, dict) for r in rows):
        raise TypeError("rows must be objects")
    nested = {"Array", "Map", "Tuple", "Nested", "Variant", "Dynamic", "JSON", "Point", "Ring", "Polygon", "MultiPolygon"}
    own = make_schema(parsed)
    loose = T.StructType([T.StructField(f.name, f.dataType if t.unwrapped().name in nested - {"Dynamic", "JSON"} else T.BinaryType() if t.unwrapped().name == "FixedString" else T.StringType()) for f, (_, t) in zip(own.fields, parsed, strict=True)])
    data = [tuple(_loose(r.get(n), t.unwrapped(), t.unwrapped().name in nested) for n, t in parsed) for r in rows]
    df = spark.createDataFrame(data, loose)
    return df.select([C.coerce(F.col(n), t, f.dataType).alias(n, metadata={"src_type": str(t)}) for (n, t), f in zip(parsed, loose.fields, strict=True)])


def _loose(value: Any, t: ColType, nested: bool) -> Any:
    import json

    if value is None:
        return None
    if t.name == "FixedString":
        return value.encode() if isinstance(value, str) else value
    if t.name in ("Dynamic", "JSON") or (not nested and isinstance(value, (dict, list))):
        return json.dumps(value)
    if isinstance(value, bool) and not nested:
        return "true" if value else "false"
    return value if nested else str(value)


def from_rows(spark: SparkSession, columns: list[tuple[str, str]], rows: Iterable[Iterable[Any]]) -> DataFrame:
    """Rows by position; each must have a value for each column."""
    names, objects = [n for n, _ in columns], []
    for i, r in enumerate(rows):
        values = list(r)
        if len(values) != len(names):
            raise ValueError(f"Row {i} has {len(values)} values, expected {len(names)}")
        objects.append(dict(zip(names, values, strict=True)))
    return from_objects(spark, columns, objects)


def from_columns(spark: SparkSession, columns: dict[str, tuple[str, list[Any]]]) -> DataFrame:
    """Columns {name: (type, values)} of equal length."""
    lengths = {n: len(v) for n, (_, v) in columns.items()}
    if len(set(lengths.values())) > 1:
        raise ValueError(f"columns differ in length: {lengths}")
    rows = zip(*(v for _, v in columns.values()), strict=True)
    return from_rows(spark, [(n, t) for n, (t, _) in columns.items()], rows)


def as_table(spark: SparkSession, table: Any) -> DataFrame:
    """An external table: a DataFrame, several of them, an Arrow table, or raw data."""
    if isinstance(table, ExternalTable):
        return formats.parse_text(spark, table.data, table.format, structure(table.structure))
    if isinstance(table, DataFrame):
        return table
    if isinstance(table, (list, tuple)):
        parts = [in_session(as_table(spark, x), spark) for x in table]
        if not parts:
            raise ValueError("an external table needs at least one batch")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    return spark.createDataFrame(table)


def in_session(df: DataFrame, session: SparkSession) -> DataFrame:
    """df's plan as a DataFrame of another session of the same context, so that its views are that session's."""
    if df.sparkSession is session:
        return df
    plan = df._jdf.queryExecution().logical()
    return DataFrame(session._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session._jsparkSession, plan), session)


def with_totals(spark: SparkSession, sql: str, args: dict[str, Any], mode: str = "after_having_exclusive") -> tuple[DataFrame, DataFrame]:
    """The groups, and one row of totals; both have the same columns and types. mode: of the groups that HAVING keeps, or "before_having"."""
    data, totals = ((spark.sql(q, args=args) if args else spark.sql(q)) for q in (sql, grand_total(sql, mode)))
    return data, totals


def fold_events(events: DataFrame) -> DataFrame:
    """(name, kind, value, seq): sums of increments, and of everything else the latest value and the peak."""
    latest = F.max_by("value", "seq")
    total = F.sum(F.when(F.col("kind") == "increment", F.col("value")))
    return events.groupBy("name").agg(F.when(F.max("kind") == "increment", total).otherwise(latest).alias("value"), F.max("value").alias("peak"))
