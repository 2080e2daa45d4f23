"""Types, coercions, the dialect shim, sessions and formats."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F, types as T

from plumbline.functions import coerce as C, nested as N
from plumbline.functions.types import TypeError_, parse, spark_type, structure
from plumbline.plans.shim import rewrite
from plumbline.session import Engine, ExternalTable, QueryError, SchemaMismatch, from_columns, from_objects, from_rows, validate_schema

ROUND_TRIP = ["Int8", "UInt64", "Int256", "Nullable(String)", "Array(Array(Int32))", "Map(String, Array(UInt8))", "Tuple(a Int32, b Nullable(String))", "Tuple(Int8, String)", "Nested(x Int32, y String)", "Variant(String, Int64)", "Enum8('a, b' = 1, 'c(d)' = -2)", "Decimal(38, 10)", "DateTime64(9)", "FixedString(4)", "LowCardinality(Nullable(String))", "JSON(a Int64)"]


@pytest.mark.parametrize("text", ROUND_TRIP)
def test_types_read_and_print(text):
    assert str(parse(str(parse(text)))) == str(parse(text))


def test_type_mapping_and_errors():
    assert spark_type("UInt64") == T.DecimalType(20, 0)
    assert spark_type("Decimal(18)") == T.DecimalType(18, 0)
    assert spark_type("Array(Nullable(Int8))") == T.ArrayType(T.ByteType(), True)
    assert spark_type("DateTime('UTC')") == T.TimestampNTZType()
    assert parse("Tuple(Date_x Int8)").names == ("Date_x",)
    for bad in ("Int7", "Array(", "Enum8('a' = 1, 'a' = 2)", "Enum8('a' = 200)", "DateTime64(12)", "Map(Int8)"):
        with pytest.raises(TypeError_):
            parse(bad)
    assert [n for n, _ in structure("id UInt32, `a b` Nullable(String)")] == ["id", "a b"]


def one(spark, value, kind):
    return from_objects(spark, [("v", kind)], [{"v": value}]).first()["v"]


MATRIX = [
    ("Int8", -128, -128), ("UInt8", 255, 255), ("Int32", " 7 ", 7), ("UInt64", 18446744073709551615, decimal.Decimal(18446744073709551615)), ("Int64", -(1 << 63), -(1 << 63)),
    ("Int128", 170141183460469231731687303715884105727, "170141183460469231731687303715884105727"), ("UInt256", None, "0"), ("Float64", "1.5", 1.5), ("Bool", "TRUE", True), ("Bool", 0, False),
    ("String", None, ""), ("String", {"a": 1}, '{"a": 1}'), ("FixedString(4)", "ab", bytearray(b"ab\0\0")), ("UUID", "61F0C4045CB311E7907BA6006AD3DBA0", "61f0c404-5cb3-11e7-907b-a6006ad3dba0"),
    ("UUID", None, C.NIL), ("IPv4", "192.168.0.1", "192.168.0.1"), ("IPv6", "2001:db8::1", "2001:0db8:0000:0000:0000:0000:0000:0001"), ("IPv6", None, ":".join(["0000"] * 8)),
    ("Enum8('a' = 1, 'b' = -2)", "a", "a"), ("Enum8('a' = 1, 'b' = -2)", 1, "a"), ("Enum8('a' = 1, 'b' = -2)", None, "b"), ("Decimal(10, 2)", "1.239", decimal.Decimal("1.23")), ("Decimal(10, 2)", "-1.239", decimal.Decimal("-1.23")),
    ("Decimal(76, 3)", "1.5", "1.500"), ("Date", "2024-02-29", datetime.date(2024, 2, 29)), ("Date32", "1900-01-01", datetime.date(1900, 1, 1)), ("DateTime", "2024-01-01 00:00:01.9", datetime.datetime(2024, 1, 1, 0, 0, 1)),
    ("DateTime64(3)", "2024-01-01 00:00:01.2345", datetime.datetime(2024, 1, 1, 0, 0, 1, 234000)), ("DateTime64(0)", "1969-12-31 23:59:58.5", datetime.datetime(1969, 12, 31, 23, 59, 59)), ("Nullable(Int32)", None, None),
    ("Array(Int32)", [1, 2], [1, 2]), ("Array(Int32)", None, []), ("Map(String, Int32)", {"a": 1}, {"a": 1}),
]


@pytest.mark.parametrize("kind,value,expected", MATRIX)
def test_coercion(spark, kind, value, expected):
    assert one(spark, value, kind) == expected


@pytest.mark.parametrize("kind,value", [("Int8", 128), ("UInt8", -1), ("Int32", 1.5), ("Int32", ""), ("UInt64", 1 << 64), ("Int128", 1 << 127), ("Bool", "maybe"), ("UUID", "zz"), ("IPv4", "256.1.1.1"), ("IPv6", "1:2"), ("IPv6", "1::2::3"), ("Enum8('a' = 1)", "x"), ("Decimal(10, 2)", "1e5"), ("FixedString(1)", "ab"), ("Date", "1969-01-01")])
def test_coercion_errors(spark, kind, value):
    with pytest.raises(Exception):
        one(spark, value, kind)


def test_shim():
    r = rewrite("SELECT count() AS n, multiIf(a > 1, 'x', b, 'y', 'z') FROM numbers(10) WHERE s = 'count() :: {a:Int8}' AND id = {id:UInt64} SETTINGS max_threads = 2 FORMAT JSONEachRow")
    assert r.format == "JSONEachRow" and r.settings == {"max_threads": "2"} and r.parameters == {"id": "UInt64"}
    assert "count(1)" in r.sql and "CASE WHEN" in r.sql and "'count() :: {a:Int8}'" in r.sql and "range(0" in r.sql
    assert "USING parquet" in rewrite("CREATE TABLE t (id UInt32, n Nullable(String)) ENGINE = MergeTree ORDER BY id").sql
    assert rewrite("OPTIMIZE TABLE t FINAL").no_op
    assert rewrite("DROP TABLE IF EXISTS t SYNC").sql.strip() == "DROP TABLE IF EXISTS t"


def test_query_parameters_totals_extremes(spark):
    engine = Engine(spark)
    assert engine.query("SELECT {a:Int32} + {b:Int32} AS s", {"a": 2, "b": 40}).collect()[0]["s"] == 42
    with pytest.raises(ValueError):
        engine.query("SELECT {a:Int32} AS s")
    r = engine.query("SELECT number % 3 AS k, count() AS n FROM numbers(10) GROUP BY number % 3 WITH TOTALS")
    assert sorted(x["n"] for x in r.collect()) == [3, 3, 4] and r.totals.collect()[0]["n"] == 10
    e = engine.query("SELECT number FROM numbers(5)").extremes.collect()
    assert {(x["extreme"], x["number"]) for x in e} == {("min", 0), ("max", 4)}
    limited = engine.query("SELECT number FROM numbers(100)", settings={"limit": 5})
    assert len(limited.collect()) == 5 and limited.rows_before_limit() == 100
    assert len(engine.query("SELECT * FROM system.numbers LIMIT 7").collect()) == 7
    with pytest.raises(QueryError):
        engine.query("SELECT nope FROM numbers(1)").collect()
    with pytest.warns(UserWarning):
        engine.query("SELECT 1", settings={"no_such_setting": 1})


def test_external_tables(spark):
    engine = Engine(spark)
    users = ExternalTable("id UInt32, name String", "1\tAlice\n2\tBob\n")
    sales = from_columns(spark, {"id": ("UInt32", [1, 1, 2]), "amount": ("Float64", [10.5, 15.5, 20.0])})
    got = engine.query("SELECT name, sum(amount) AS t FROM users JOIN sales ON users.id = sales.id GROUP BY name ORDER BY name", external_tables={"users": users, "sales": sales})
    assert [tuple(r) for r in got.collect()] == [("Alice", 26.0), ("Bob", 20.0)]
    assert engine.query("SELECT count() AS n FROM t", external_tables={"t": [sales, sales]}).collect()[0]["n"] == 6
    empty = from_rows(spark, [("id", "UInt32")], [])
    assert engine.query("SELECT count() AS n FROM t", external_tables={"t": empty}).collect()[0]["n"] == 0
    for data, form in (('{"id": 1, "x": 2}\n{"id": 3}\n', "JSONEachRow"), ("1\n3\n", "CSV")):
        assert engine.query("SELECT sum(id) AS s FROM t", external_tables={"t": ExternalTable("id UInt32", data, form)}).collect()[0]["s"] == 4


def test_insert_and_copy(spark):
    engine = Engine(spark)
    spark.sql(rewrite("CREATE TABLE ins (id UInt32, name String) ENGINE = Memory").sql)
    spark.sql(rewrite("CREATE TABLE ins2 EMPTY AS ins").sql)
    assert engine.insert("ins", [{"id": 1, "name": None, "other": 5}, {"id": 2}], [("id", "UInt32"), ("name", "String")]) == 2
    engine.copy("ins", "ins2")
    assert sorted(tuple(r) for r in spark.table("ins2").collect()) == [(1, ""), (2, "")]
    with pytest.raises(SchemaMismatch):
        validate_schema([("a", "Int32")], [("a", "Int64")])
    with pytest.raises(TypeError):
        engine.insert("ins", [5], [("id", "UInt32"), ("name", "String")])
    with pytest.raises(ValueError):
        from_rows(spark, [("a", "Int8"), ("b", "Int8")], [(1,)])
    spark.sql("DROP TABLE ins")
    spark.sql("DROP TABLE ins2")


def test_nested_round_trips(spark):
    df = spark.createDataFrame([(1, [3, 1]), (2, [5])], "id int, a array<int>")
    assert sorted(map(tuple, N.unflatten(N.flatten(df, "a"), ["id"], "a").collect())) == [(1, [3, 1]), (2, [5])]
    assert N.differences(df, df) == (0, 0) and N.differences(df, df.limit(1)) == (1, 0)
    m = spark.sql("SELECT map('b', 1, 'a', 2) AS m, parse_json('{\"k\": 1}') AS v")
    w = spark.sql("SELECT map('a', 2, 'b', 1) AS m, parse_json('{\"k\":1}') AS v")
    assert N.differences(m, w) == (0, 0)


def test_formats(spark, tmp_path):
    from plumbline.sources import formats

    columns = structure("id UInt32, name String")
    df = from_rows(spark, [("id", "UInt32"), ("name", "String")], [(1, "a b"), (2, 'q"x')])
    for form in ("JSONEachRow", "CSV", "Parquet"):
        formats.write(df, form, f"{tmp_path}/{form}")
        assert sorted(map(tuple, formats.read(spark, f"{tmp_path}/{form}", form, columns).collect())) == [(1, "a b"), (2, 'q"x')]
    formats.write(df, "Null", "")
    assert len(list(formats.json_lines(df))) == 2


def test_stream_equals_batch(spark):
    from plumbline.streaming.windows import hourly, run_to_end, stream_of

    path = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(path).groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("start")).agg(F.count(F.lit(1)).alias("n"))
    streamed = run_to_end(spark, hourly(stream_of(spark, path))).select("start", "n")
    assert N.differences(batch, streamed) == (0, 0)


BLOCK_TYPES = [
    ("Int8", [-5, 0]), ("UInt8", [200, 0]), ("Int64", [-1234567890123, 1]), ("UInt64", [decimal.Decimal(9000000000000), decimal.Decimal(0)]), ("Float32", [1.25, 0.0]), ("Float64", [-1.25, 0.0]), ("Bool", [True, False]),
    ("Int128", [str((1 << 127) - 1), "-1"]), ("UInt256", [str((1 << 256) - 1), "0"]), ("Date", [datetime.date(2024, 1, 15), datetime.date(1970, 1, 1)]), ("Date32", [datetime.date(1900, 1, 1), datetime.date(2024, 6, 30)]),
    ("DateTime", [datetime.datetime(2024, 1, 15, 10, 30), datetime.datetime(1970, 1, 1)]), ("DateTime64(3)", [datetime.datetime(2024, 1, 15, 10, 30, 0, 123000), datetime.datetime(1969, 12, 31, 23, 59, 59)]), ("DateTime64(9)", [1700000000123456789, -1]),
    ("String", ["hello", "é\n"]), ("FixedString(5)", [bytearray(b"hello"), bytearray(b"a\0\0\0\0")]), ("UUID", ["550e8400-e29b-41d4-a716-446655440000", C.NIL]), ("IPv4", ["192.168.0.1", "0.0.0.0"]),
    ("IPv6", ["2001:0db8:0000:0000:0000:0000:0000:0001", ":".join(["0000"] * 8)]), ("Enum8('a' = 1, 'b' = 2)", ["b", "a"]), ("Enum16('a' = -300, 'b' = 2)", ["a", "b"]), ("Decimal(9, 2)", [decimal.Decimal("12.34"), decimal.Decimal("-0.01")]),
    ("Decimal(38, 6)", [decimal.Decimal("12345.678901"), decimal.Decimal("-1.000000")]), ("Decimal(76, 10)", ["-1234567890.0123456789", "0.0000000000"]), ("Nullable(Int32)", [None, 3]), ("Nullable(String)", ["", None]), ("Array(Int32)", [[1, 2, 3], []]),
    ("Array(Nullable(String))", [["a", None], []]), ("Map(String, Int32)", [{"a": 1, "b": 2}, {}]), ("Tuple(Int32, String)", [(7, "x"), (0, "")]), ("Tuple(x Int32, y Array(String))", [(7, ["x"]), (0, [])]), ("Nested(id Int32, name String)", [[(1, "a"), (2, "b")], []]),
    ("LowCardinality(String)", ["active", "x"]), ("LowCardinality(Nullable(String))", [None, "x"]), ("Point", [(1.5, 2.5), (0.0, 0.0)]), ("Ring", [[(0.0, 0.0), (1.0, 0.0)], []]), ("MultiPolygon", [[[[(0.0, 1.0)]]], []]),
]


@pytest.mark.parametrize("kind,values", BLOCK_TYPES)
def test_blocks_round_trip(spark, kind, values):
    from plumbline.sources import blocks

    columns = [("id", "UInt32"), ("v", kind)]
    rows = list(enumerate(values))
    data = blocks.encode(columns, rows)
    found, back = blocks.decode(data)
    assert found == [("id", "UInt32"), ("v", str(parse(kind)))] and back == rows
    cut = [data[i : i + 7] for i in range(0, len(data), 7)]
    assert [r for _, r in blocks.stream_decode(cut * 2)] == [rows, rows]
    packed = spark.createDataFrame([(bytearray(data),)], "block binary")
    got = {r["id"]: r["v"] for r in blocks.from_blocks(packed, columns).collect()}
    plain = lambda v: tuple(map(plain, v)) if isinstance(v, (tuple, list)) else v
    assert {i: plain(v) for i, v in got.items()} == {i: plain(v) for i, v in rows}


def test_block_streams():
    from plumbline.sources import blocks

    columns = [("a", "Int8")]
    assert b"".join(blocks.stream_encode(columns, [[(1,)], []])) == b"\1\1\1a\4Int8\1" + b"\1\0\1a\4Int8"
    assert blocks.decode(b"\1\0\1a\4Int8") == ([("a", "Int8")], [])
    assert list(blocks.stream_decode([b"\0\0", blocks.encode(columns, [(5,)])])) == [([("a", "Int8")], [(5,)])]
    with pytest.raises(blocks.Truncated):
        list(blocks.stream_decode([blocks.encode(columns, [(5,)])[:-1]]))
    for method in ("none", "lz4", "zstd"):
        frame = blocks.pack(b"abc" * 100, method)
        assert blocks.unpack(frame) == b"abc" * 100
        with pytest.raises(ValueError):
            blocks.unpack(frame[:-1] + b"?")


def test_random_tables(spark):
    from plumbline.sources.random_data import random_structure, random_table

    text = ", ".join(f"c{i} {k}" for i, (k, _) in enumerate(BLOCK_TYPES) if not k.startswith(("Nested", "Point", "Ring", "Multi", "Decimal(76")))
    df = random_table(spark, text, 200, 4)
    rows = df.collect()
    assert rows == random_table(spark, text, 200, 4).collect() != random_table(spark, text, 200, 5).collect()
    assert len({r["c3"] for r in rows}) > 190 and df.schema["c0"].metadata["src_type"] == "Int8"
    assert random_structure(3, 7) == random_structure(3, 7) and len(structure(random_structure(None, 2))) >= 1


def test_totals(spark):
    engine = Engine(spark)
    r = engine.query("SELECT number % 3 AS k, count() AS n FROM numbers(10) GROUP BY k WITH TOTALS HAVING count() < 4 ORDER BY k LIMIT 1")
    assert [tuple(x) for x in r.collect()] == [(1, 3)] and [tuple(x) for x in r.totals.collect()] == [(None, 6)] and r.totals.dtypes == r.data.dtypes
    r = engine.query("SELECT k, sum(n) AS s FROM (SELECT number % 2 AS k, number AS n FROM numbers(6) WHERE number > 0) d GROUP BY 1 WITH TOTALS")
    assert [tuple(x) for x in r.totals.collect()] == [(None, 15)]
    with pytest.raises(Exception):
        engine.query("SELECT 1 WITH TOTALS")


def test_progress_batches_columns(spark):
    from plumbline.session import parse_summary

    r = Engine(spark).query("SELECT number, toString(number) AS t FROM numbers(25000)")
    parts = list(r.batches())
    assert sum(p.num_rows for p in parts) == 25000 and parts[0].schema.names == ["number", "t"]
    assert r.progress.tasks_done == r.progress.tasks > 0 and r.progress.percent == 100
    few = Engine(spark).query("SELECT number FROM numbers(5)")
    assert few.column("number") == [0, 1, 2, 3, 4] and few.at(3, "number") == 3 and few.progress.result_rows >= 5
    assert parse_summary('{"read_rows": "7", "elapsed_ns": 2000000000, "result_rows": null}').read_rows == 7
    assert parse_summary("not json").read_rows == parse_summary(None).result_rows == 0


def test_text_faults(spark):
    two = "id UInt32, s String"
    rows = lambda data, form="TabSeparated": [tuple(r) for r in Engine(spark).query("SELECT * FROM t", external_tables={"t": ExternalTable(two, data, form)}).collect()]
    assert rows("1\ta\\\\tb\n2\t\\tx\\n\n") == [(1, "a\\tb"), (2, "\tx\n")]
    assert rows('1,"a\nb"\n2,"q""x"\n', "CSV") == [(1, "a\nb"), (2, 'q"x')]
    one = Engine(spark).query("SELECT count() AS n FROM t", external_tables={"t": ExternalTable("s String", "a\n\nb\n")})
    assert one.collect()[0]["n"] == 3


def test_tab_separated_files(spark, tmp_path):
    from plumbline.sources import formats

    df = from_rows(spark, [("id", "UInt32"), ("s", "Nullable(String)")], [(1, "a\tb\\n\n"), (2, None), (3, "")])
    for form in ("TSV", "TabSeparatedWithNames"):
        formats.write(df, form, f"{tmp_path}/{form}")
        assert sorted(map(tuple, formats.read(spark, f"{tmp_path}/{form}", form, structure("id UInt32, s Nullable(String)")).collect())) == [(1, "a\tb\\n\n"), (2, None), (3, "")]


def test_strict_nested_values(spark):
    assert one(spark, True, "Float64") == 1.0
    assert one(spark, "2024-01-01 00:00:00.123456789", "DateTime64(9)") == 1704067200123456789
    got = from_objects(spark, [("v", "Dynamic")], [{"v": 5}, {"v": {"a": 1}}, {"v": "x"}]).select(F.schema_of_variant("v").alias("k")).collect()
    assert [r["k"] for r in got] == ["BIGINT", "OBJECT<a: BIGINT>", "STRING"]
    ticks = spark.createDataFrame([(1700000000123456999,)], "t long").select(F.unix_micros(C.ticks_to_timestamp(F.col("t"), 9, closest=True)).alias("m"))
    assert ticks.first()["m"] == 1700000000123456
    with pytest.raises(Exception):
        one(spark, {"a": 300}, "Map(String, Int8)")
    assert one(spark, None, "Point") == (0.0, 0.0) and one(spark, None, "Ring") == [] and one(spark, None, "Nested(a Int8, b String)") == []


def test_nested_keeps_nulls(spark):
    df = spark.createDataFrame([(1, [3, 1]), (2, []), (3, None), (4, [None, 2])], "id int, a array<int>")
    assert sorted(map(tuple, N.unflatten(N.flatten(df, "a"), ["id"], "a").collect())) == [(1, [3, 1]), (2, []), (3, None), (4, [None, 2])]
    words = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "id int, w string")
    values, coded = N.dictionary_encode(words, "w")
    assert sorted(map(tuple, coded.select("id", "code").collect())) == [(1, 1), (2, None), (3, 0), (4, 1)] and values.count() == 2
    assert N.common_type(["UInt8", "Int16"]) == "Int16" and N.common_type(["UInt32", "Int8"]) == "Int64" and N.common_type(["Int8", "Nullable(Float32)"]) == "Nullable(Float64)"
    assert N.common_type(["Int8", "String"]) == "Variant(Int8, String)" and N.common_type(["String", "String"]) == "String"


def test_insert_batches(spark):
    engine = Engine(spark)
    spark.sql("CREATE TABLE ins3 (id BIGINT, name STRING) USING parquet")
    parts = [from_rows(spark, [("id", "Int64"), ("name", "String")], [(i, "x")]) for i in range(3)]
    assert engine.insert("ins3", parts) == 3
    assert engine.insert("ins3", ({"id": i} for i in range(25)), batch_size=10) == 25 and spark.table("ins3").count() == 28
    spark.sql("DROP TABLE ins3")


def test_command_line(spark, tmp_path):
    import json

    from plumbline.__main__ import run

    spark.sql("CREATE TABLE cli (id BIGINT, s STRING) USING parquet")
    (tmp_path / "rows.jsonl").write_text('{"id": "7", "s": null}\n{"id": 8}\n')
    said = []
    failed = run(Engine(spark), [f"\\load {tmp_path}/rows.jsonl INTO cli", "SELECT number AS n FROM numbers(2) SETTINGS extremes = 1;", "SELECT nope", "\\q", "SELECT 1"], said.append)
    said = [json.loads(x) for x in said]
    assert failed == 1 and [x["type"] for x in said] == ["loaded", "header", "row", "row", "extremes", "progress", "exception"]
    assert said[2]["row"] == {"n": 0} and sorted(map(tuple, spark.table("cli").collect())) == [(7, ""), (8, "")]
    spark.sql("DROP TABLE cli")


def test_streams_equal_batch(spark):
    from plumbline.streaming.windows import distinct_events, run_to_end, sessions, stream_of

    path = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(path)
    assert run_to_end(spark, distinct_events(stream_of(spark, path)), "append").count() == batch.select("event_id").distinct().count()
    done = run_to_end(spark, sessions(stream_of(spark, path)), "append")
    lost, made = N.differences(sessions(batch), done)
    assert made == 0 and done.count() > 0


NULL_IN = [
    ("SELECT x IN (1, NULL) FROM t", [True, True, False]), ("SELECT x NOT IN (1, NULL) FROM t", [False, False, True]), ("SELECT x IN (1) FROM t", [True, False, False]),
    ("SELECT x + 1 IN (2, 3) FROM t", [True, False, True]), ("SELECT (x, y) IN ((1, 'a'), (NULL, NULL)) FROM t", [True, True, False]), ("SELECT CASE WHEN y = 'b' THEN x END IN (2) FROM t", [False, False, True]),
    ("SELECT coalesce(t.y, 'none') IN ('a', 'none') AND t.x IN (NULL) FROM t", [False, True, False]), ("SELECT x IN (x * 1, 5) FROM t", [True, True, True]), ("SELECT 'x IN (1)' IN ('x IN (1)') FROM t", [True] * 3),
]


@pytest.mark.parametrize("sql,expected", NULL_IN)
def test_null_in(spark, sql, expected):
    t = spark.createDataFrame([(1, "a"), (None, None), (2, "b")], "x int, y string").coalesce(1)
    got = Engine(spark, {"transform_null_in": 1}).query(sql, external_tables={"t": t}).collect()
    assert [r[0] for r in got] == expected


def test_null_in_of_a_query(spark):
    t = spark.createDataFrame([(1, "a"), (None, None), (2, "b"), (2, None)], "x int, y string")
    engine = Engine(spark, {"transform_null_in": 1})

    def rows(condition):
        return sorted((str(r[0]), str(r[1])) for r in engine.query(f"SELECT x, y FROM t WHERE {condition}", external_tables={"t": t}).collect())

    assert rows("x IN (SELECT x FROM t WHERE x IS NULL)") == [("None", "None")]
    assert rows("(x, y) NOT IN (SELECT x, y FROM t WHERE y IN ('a', NULL))") == [("2", "b")]
    plan = engine.query("SELECT y FROM t WHERE x IN (SELECT x FROM t)", external_tables={"t": t}).data._jdf.queryExecution().toString()
    assert "LeftSemi" in plan and "NestedLoop" not in plan
    assert rewrite("SELECT x IN (1, NULL)").sql == "SELECT x IN (1, NULL)"


def test_most_rows_to_read(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    assert Engine(spark, {"max_rows_to_read": 1000}).query("SELECT sum(id) AS s FROM t", external_tables={"t": t}).collect()[0]["s"] == 499500
    with pytest.raises(QueryError, match="more than 999 rows were read"):
        Engine(spark, {"max_rows_to_read": 999}).query("SELECT sum(id) AS s FROM t", external_tables={"t": t}).collect()


@pytest.mark.parametrize("width", [1, 3])
def test_range_join(spark, monkeypatch, width):
    """All pairs in range, and a large group's pairs are not one task's work."""
    from plumbline.operators import library

    monkeypatch.setattr(library, "SIDE", 8)
    rows = [(k, "x" if k % 9 else None if k % 2 else "y", None if k % 11 == 0 else k % 13 - 6 if k % 3 else 2) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, g string, v int")
    got = library.range_join(df, df, "g", "v", width).select("a.id", "b.id", F.spark_partition_id()).collect()
    want = [(a, b) for a, g, v in rows for b, h, w in rows if g is not None and g == h and v is not None and w is not None and v < w <= v + width]
    assert sorted(r[:2] for r in got) == sorted(want)
    assert max(sum(r[2] == p for r in got) for p in {r[2] for r in got}) < len(got) / 4
    assert library.range_join(df.limit(0), df, "g", "v", width).count() == 0


def test_range_join_compares_few(spark):
    """The query's rows meet by brand and size, not by brand alone."""
    from plumbline.operators.catalog import QUERIES

    plan = QUERIES["join_range"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "_cell" in next(line for line in plan.splitlines() if "Join Inner" in line)


def test_sketch_beside_distinct(spark):
    """No sketch is kept for each distinct value: it has the distinct values themselves, with the same result."""
    sql = "SELECT k, approx_count_distinct(v, 0.01) AS a, count(DISTINCT v) AS n, 'f(DISTINCT' AS s FROM t GROUP BY k"
    t = spark.range(20000).selectExpr("id % 3 AS k", "IF(id % 10 = 0, NULL, id % 700) AS v")
    df = Engine(spark).query(sql, external_tables={"t": t}).data
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "merge_approx_count_distinct" not in plan
    alone = {r["k"]: r["a"] for r in t.groupBy("k").agg(F.approx_count_distinct("v", 0.01).alias("a")).collect()}
    assert {r["k"]: r["a"] for r in df.collect()} == alone
    assert rewrite("SELECT approx_count_distinct(a), '(DISTINCT' FROM t").sql == "SELECT approx_count_distinct(a), '(DISTINCT' FROM t"
    over = "SELECT approx_count_distinct(a) OVER (PARTITION BY b), (SELECT count(DISTINCT a) FROM t) FROM t"
    assert rewrite(over).sql == over


@pytest.mark.parametrize(
    "kind,values",
    [
        *BLOCK_TYPES,
        ("UInt64", [decimal.Decimal((1 << 64) - 1), decimal.Decimal(0)]), ("Float64", [float("inf"), -0.0]), ("DateTime64(6)", [datetime.datetime(2024, 1, 15, 10, 30, 0, 123456), datetime.datetime(1, 1, 1)]),
        ("String", ["x" * 127, "é" * 64, "", "y" * 20000]), ("Nullable(UInt64)", [None, decimal.Decimal(7)]), ("Nullable(DateTime64(6))", [None, datetime.datetime(1969, 12, 31)]), ("LowCardinality(String)", ["", "x" * 200, "x"]),
        ("Map(String, Float64)", [{}, {"a": 1.5, "n": None}, {"a" * 300: -1.0}]), ("Map(String, Array(Nullable(Int64)))", [{"a": [1, None], "b": []}, {}]), ("Array(Tuple(Int64, LowCardinality(Nullable(String))))", [[(1, None), (2, "x")], [], [(3, "x")]]),
    ],
)
def test_blocks_by_columns(kind, values):
    """A batch's block has the bytes of its rows' block, and is read as the same batch, also from a slice and with nulls."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    from plumbline.functions.types import schema
    from plumbline.sources import blocks

    columns = [("v", str(parse(kind)))]
    arrow = to_arrow_schema(schema(columns))
    whole = blocks._arrow([values[-1], *values, None, *values, values[0]], arrow.field(0).type)
    for v in (whole, whole[1:-1], whole[1 : len(values) + 1], whole[:0]):
        data = blocks.arrow_encode(columns, pa.RecordBatch.from_arrays([v], schema=arrow))
        assert data == blocks.encode(columns, [(x,) for x in v.to_pylist()])
        rows = [r[0] for r in blocks.decode(data)[1]]
        got = blocks.arrow_decode(data, columns, arrow)
        assert got.schema == arrow and got.column(0).to_pylist() == blocks._arrow(rows, arrow.field(0).type).to_pylist()
        got.validate(full=True)
        for cut in range(len(data)) if len(v) else ():
            if cut < 100 or cut > len(data) - 100:
                with pytest.raises((blocks.Truncated, ValueError)):
                    blocks.arrow_decode(data[:cut], columns, arrow)


def test_blocks_odd_bytes():
    """Of equal keys of a map the last counts; other columns, and text that isn't UTF-8, are faults."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    from plumbline.functions.types import schema
    from plumbline.sources import blocks

    columns = [("v", "Map(String, Int64)")]
    arrow = to_arrow_schema(schema(columns))
    data = blocks.encode(columns, [([("a", 1), ("b", 2), ("a", 3)],), ([("a", 4)],)])
    assert blocks.arrow_decode(data, columns, arrow).column(0).to_pylist() == [[("a", 3), ("b", 2)], [("a", 4)]]
    with pytest.raises(ValueError, match="columns are"):
        blocks.arrow_decode(data, [("w", columns[0][1])], arrow)
    texts = [("v", "String")]
    with pytest.raises(UnicodeDecodeError):
        blocks.arrow_decode(blocks.encode(texts, [(b"\xff",)]), texts, to_arrow_schema(schema(texts)))
    # As fast as columns are: no Python object is made of a number or a text.
    some = pa.RecordBatch.from_pydict({"v": pa.array(["x"] * 5)})
    made = []
    values, blocks._values = blocks._values, lambda *a: made.append(a) or values(*a)
    try:
        blocks.arrow_encode(texts, some)
    finally:
        blocks._values = values
    assert not made
