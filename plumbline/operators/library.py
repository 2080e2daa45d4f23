"""Queries that use the package's own operators, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions import coerce as C, nested as N
from ..session import Engine
from .catalog import query, table


def asof_join(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, value: str) -> DataFrame:
    """left with the value of the latest row of right at or before its time, for the same key: one sort of both sides together."""
    both = left.select(by, F.col(left_time).alias("_t"), F.lit(1).alias("_left"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    both = both.unionByName(right.select(by, F.col(right_time).alias("_t"), F.lit(0).alias("_left"), F.lit(None).cast(both.schema["_row"].dataType).alias("_row"), F.col(value).alias("_v")))
    latest = F.last("_v", ignorenulls=True).over(Window.partitionBy(by).orderBy("_t", "_left").rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn(value, latest).filter("_left = 1").select("_row.*", value)


#: Rows of a side of a range join that are paired in one place, about.
SIDE = 2048


def range_join(left: DataFrame, right: DataFrame, by: str, at: str, width: int) -> DataFrame:
    """Pairs of rows (struct a of left, struct b of right) with the same by and a.at < b.at <= a.at + width; at is a whole number.

    Rows meet in cells of width whole numbers, so that only rows of neighbouring cells are compared. A group of more rows
    than SIDE is dealt into pieces on each side, every piece of one side meets every piece of the other, and so no task
    holds a group: rows are copied 2 / SIDE times a pair at most.
    """
    spark = left.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    x, key = F.col(at).cast("long"), ["_by", "_cell"]
    # Cell k has the numbers above (k - 1) * width up to k * width.
    above, below = (x % width > 0).cast("long"), (x % width < 0).cast("long")
    whole = F.expr(f"CAST({at} AS LONG) DIV {width}")

    def rows(df: DataFrame, name: str, cell) -> DataFrame:
        return df.select(F.struct(*df.columns).alias(name), F.col(by).alias("_by"), cell.alias("_cell"), F.monotonically_increasing_id().alias("_n")).filter("_by is not null and _cell is not null")

    a = rows(left, "a", F.explode(F.sequence(whole - below + 1, whole + above + 1)))
    b = rows(right, "b", whole + above)
    sizes = [df.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / SIDE).alias(name)) for df, name in ((a, "_as"), (b, "_bs"))]
    # Few groups are large: one for each SIDE rows at most.
    large = sizes[0].join(sizes[1], key).filter("_as > 1 or _bs > 1")

    def dealt(df: DataFrame, own: str, others: str) -> DataFrame:
        piece = F.pmod(F.xxhash64("_n"), F.coalesce(own, F.lit(1))).alias(own[:2])
        df = df.join(F.broadcast(large), key, "left").select(df.columns[0], *key, piece, F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce(others, F.lit(1)))).alias(others[:2]))
        return df.withColumn(others[:2], F.col(others[:2]) - 1).repartition(tasks, *key, "_a", "_b")

    pairs = dealt(a, "_as", "_bs").hint("merge").join(dealt(b, "_bs", "_as"), [*key, "_a", "_b"])
    return pairs.filter(f"b.{at} > a.{at} AND b.{at} <= a.{at} + {width}").select("a", "b")


@query("SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_brand = b.p_brand AND b.p_size > a.p_size AND b.p_size <= a.p_size + 1")
def join_range(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return range_join(part, part, "p_brand", "p_size", 1).select(F.col("a.p_partkey").alias("a"), F.col("b.p_partkey").alias("b"))


def session_ids(df: DataFrame, by: str, time: str, gap: str) -> DataFrame:
    """df with the number of its session: a new one after a gap."""
    w = Window.partitionBy(by).orderBy(time)
    starts = F.coalesce(F.col(time) - F.lag(time).over(w) > F.expr(f"INTERVAL {gap}"), F.lit(True))
    return df.withColumn("session", F.sum(starts.cast("int")).over(w).cast("long"))


def with_fill(df: DataFrame, key: str, default: dict[str, object]) -> DataFrame:
    """df with rows for the whole numbers that are missing between the least and the greatest key."""
    ends = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    full = ends.filter("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias(key))
    return full.join(df, key, "left").fillna(default)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000.5 AND o_orderstatus = 'F'")
def param_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    out = Engine(spark).query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > {least:Float64} AND o_orderstatus = {status:String}", {"least": 300000.5, "status": "F"}, {"orders": orders})
    return out.data


@query("SELECT u.name AS name, CAST(round(sum(s.amount), 1) AS DOUBLE) AS total FROM (VALUES (1, 'Alice'), (2, 'Bob')) u(id, name) JOIN (VALUES (1, 10.5), (1, 15.5), (2, 20.0)) s(id, amount) ON u.id = s.id GROUP BY u.name ORDER BY name")
def external_tables(spark, sf_dir):
    from ..session import ExternalTable, from_rows

    users = from_rows(spark, [("id", "UInt32"), ("name", "String")], [(1, "Alice"), (2, "Bob")])
    sales = ExternalTable("id UInt32, amount Float64", "1\t10.5\n1\t15.5\n2\t20\n")
    return Engine(spark).query("SELECT name, round(sum(amount), 1) AS total FROM users JOIN sales ON users.id = sales.id GROUP BY name ORDER BY name", external_tables={"users": users, "sales": sales}).data


@query("SELECT l_orderkey, l_linenumber, CAST(trunc(CAST(l_extendedprice AS DECIMAL(18,4)) * 10) / 10 AS DECIMAL(18,1)) AS cut FROM lineitem")
def decimal_truncate(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", C.to_decimal(F.col("l_extendedprice").cast("decimal(18,4)"), 18, 1).alias("cut"))


@query("SELECT event_id, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INT) AS code FROM events")
def dictionary_encode(spark, sf_dir):
    _, coded = N.dictionary_encode(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type")
    return coded.select("event_id", F.col("code").cast("int").alias("code"))


@query("SELECT r.idx AS idx, coalesce(e.value, 0.0) AS value FROM (SELECT unnest(range((SELECT max(event_id) + 1 FROM events))) AS idx) r LEFT JOIN (SELECT event_id, value FROM events WHERE event_type = 'click') e ON r.idx = e.event_id")
def sparse_densify(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    n = events.agg(F.max("event_id").alias("m")).first()["m"]
    return N.densify(events.filter("event_type = 'click'").select(F.col("event_id").alias("idx"), "value"), 0 if n is None else n + 1, F.lit(0.0))


@query("SELECT vec_id, CAST(len(embedding) AS INT) AS n, true AS same FROM embeddings")
def array_roundtrip(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    back = N.unflatten(N.flatten(e, "embedding"), ["vec_id"], "again")
    return e.join(back, "vec_id").select("vec_id", F.size("again").alias("n"), (F.col("again") == F.col("embedding")).alias("same"))


@query("SELECT DISTINCT unnest(json_keys(props)) AS path FROM events")
def json_discovery(spark, sf_dir):
    return N.json_paths(table(spark, sf_dir, "events"), "props")


@query("SELECT event_id, CASE WHEN value < 10 THEN 0 ELSE 1 END AS d, CASE WHEN value < 10 THEN value END AS small, CASE WHEN value >= 10 THEN CAST(floor(value) AS BIGINT) END AS big FROM events")
def variant_dispatch(spark, sf_dir):
    union = N.tagged([(F.col("value") < 10, F.col("value")), (F.lit(True), F.floor("value"))], ["double", "long"])
    e = table(spark, sf_dir, "events").select("event_id", union.alias("u"))
    return e.select("event_id", F.col("u.d").cast("int").alias("d"), N.tag_value(F.col("u"), 0).alias("small"), N.tag_value(F.col("u"), 1).alias("big"))


@query("""SELECT c.event_id AS event_id, (SELECT arg_max(e.value, e.ts) FROM events e WHERE e.event_type = 'error' AND e.user_id = c.user_id AND e.ts <= c.ts) AS last_error
          FROM events c WHERE c.event_type = 'click'""")
def asof(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    clicks = e.filter("event_type = 'click'").select("event_id", "user_id", "ts")
    errors = e.filter("event_type = 'error'").select("user_id", F.col("ts").alias("at"), F.col("value").alias("last_error"))
    return asof_join(clicks, errors, "user_id", "ts", "at", "last_error").select("event_id", "last_error")


@query("""SELECT user_id, CAST(count(*) AS BIGINT) AS sessions FROM (SELECT user_id, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS d FROM events) x WHERE d IS NULL OR d > INTERVAL 1 HOUR GROUP BY user_id""")
def sessions(spark, sf_dir):
    return session_ids(table(spark, sf_dir, "events"), "user_id", "ts", "1 HOUR").groupBy("user_id").agg(F.max("session").alias("sessions"))


@query("""SELECT k, coalesce(n, 0) AS n FROM (SELECT unnest(range(lo, hi + 1)) AS k FROM (SELECT min(o_custkey) AS lo, max(o_custkey) AS hi FROM orders) e) f
          LEFT JOIN (SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey) c ON k = o_custkey""")
def fill_gaps(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return with_fill(counts, "k", {"n": 0})


@query("SELECT CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra")
def write_read_back(spark, sf_dir):
    """JSON lines written and parsed again hold the same rows, by canonical hash in both directions."""
    nation = table(spark, sf_dir, "nation")
    lines = nation.select(F.to_json(F.struct(*nation.columns)).alias("j"))
    back = lines.select(F.from_json("j", nation.schema).alias("r")).select("r.*")
    x, y = nation.select(N.row_hash(nation).alias("h")), back.select(N.row_hash(back).alias("h"))
    return x.exceptAll(y).agg(F.count(F.lit(1)).alias("missing")).crossJoin(y.exceptAll(x).agg(F.count(F.lit(1)).alias("extra")))


@query("SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY l_returnflag")
def shim_dialect(spark, sf_dir):
    """count() without arguments, a cast with ::, and suffixes, through the dialect shim."""
    sql = "SELECT l_returnflag, count()::Int64 AS n FROM lineitem GROUP BY l_returnflag SETTINGS max_threads = 4 FORMAT JSON"
    return Engine(spark).query(sql, external_tables={"lineitem": table(spark, sf_dir, "lineitem")}).data


def engine_query(spark, sf_dir, sql, *tables, **options):
    """A query of an engine whose tables are external ones."""
    return Engine(spark).query(sql, external_tables={t: table(spark, sf_dir, t) for t in tables}, **options)


@query("SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, round(sum(l_quantity), 2) AS q FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), ())")
def with_totals(spark, sf_dir):
    """The groups, and the row of totals beside them, whose columns have the same types."""
    r = engine_query(spark, sf_dir, "SELECT l_returnflag, count() AS n, round(sum(l_quantity), 2) AS q FROM lineitem GROUP BY l_returnflag WITH TOTALS", "lineitem")
    assert r.data.dtypes == r.totals.dtypes
    return r.data.unionByName(r.totals)


@query("""SELECT event_id, (k IS NULL OR k IN (1, 3)) AS listed, k IS NOT NULL AND k NOT IN (1, 3) AS unlisted, (k IS NOT DISTINCT FROM event_id % 5 OR k IS NULL) AS computed
          FROM (SELECT event_id, nullif(event_id % 7, 0) AS k FROM events) e WHERE k IS NULL OR k IN (SELECT n_regionkey FROM nation WHERE n_regionkey <> 1)""")
def null_in(spark, sf_dir):
    """IN and NOT IN where null equals null: lists of literals, lists of expressions, and a statement's rows."""
    sql = """SELECT event_id, k IN (1, NULL, 3) AS listed, k NOT IN (1, NULL, 3) AS unlisted, k IN (event_id % 5, NULL) AS computed
             FROM (SELECT event_id, nullif(event_id % 7, 0) AS k FROM events) e
             WHERE k IN (SELECT nullif(n_regionkey, 1) FROM nation) SETTINGS transform_null_in = 1"""
    return engine_query(spark, sf_dir, sql, "events", "nation").data


@query("""WITH k AS (SELECT year(o_orderdate) AS y FROM orders GROUP BY 1 HAVING count(*) > (SELECT count(*) / 8 FROM orders))
          SELECT NULL::BIGINT AS y, CAST(count(*) AS BIGINT) AS n FROM orders WHERE year(o_orderdate) IN (SELECT y FROM k)""")
def totals_having(spark, sf_dir):
    """Totals of the groups that HAVING keeps, by an expression over a derived table."""
    sql = "SELECT CAST(year(d) AS BIGINT) AS y, count() AS n FROM (SELECT o_orderdate AS d FROM orders) x GROUP BY year(d) WITH TOTALS HAVING count(*) > (SELECT count(*) / 8 FROM orders)"
    return engine_query(spark, sf_dir, sql, "orders").totals


@query("SELECT CAST(NULL AS VARCHAR) AS l_returnflag, CAST(count(*) AS BIGINT) AS n FROM lineitem")
def totals_before_having(spark, sf_dir):
    sql = "SELECT l_returnflag, count() AS n FROM lineitem GROUP BY l_returnflag WITH TOTALS HAVING count(*) < 0"
    return engine_query(spark, sf_dir, sql, "lineitem", settings={"totals_mode": "before_having"}).totals


@query("SELECT 'min' AS extreme, min(o_totalprice) AS price, min(o_orderkey) AS id FROM orders UNION ALL SELECT 'max', max(o_totalprice), max(o_orderkey) FROM orders")
def extremes(spark, sf_dir):
    return engine_query(spark, sf_dir, "SELECT o_totalprice AS price, o_orderkey AS id FROM orders", "orders").extremes


@query("SELECT CAST(range AS BIGINT) AS number FROM range(1000)")
def numbers(spark, sf_dir):
    return Engine(spark).query("SELECT number FROM numbers(1000)").data


@query("SELECT CAST(range AS BIGINT) AS number FROM range(500)")
def system_numbers(spark, sf_dir):
    return Engine(spark).query("SELECT number FROM system.numbers LIMIT 500").data


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 10 THEN 'few' WHEN l_quantity < 30 THEN 'some' ELSE 'many' END AS size FROM lineitem")
def multi_if(spark, sf_dir):
    return engine_query(spark, sf_dir, "SELECT l_orderkey, l_linenumber, multiIf(l_quantity < 10, 'few', l_quantity < 30, 'some', 'many') AS size FROM lineitem", "lineitem").data


@query("SELECT 'row_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS k FROM lineitem")
def concat_cast(spark, sf_dir):
    return engine_query(spark, sf_dir, "SELECT concat('row_', toString(l_orderkey), '_', l_linenumber::String) AS k FROM lineitem", "lineitem").data


@query("SELECT CAST('18446744073709551615' AS DECIMAL(20,0)) AS u, r_regionkey FROM region")
def unsigned_cast(spark, sf_dir):
    return engine_query(spark, sf_dir, "SELECT toUInt64('18446744073709551615') AS u, r_regionkey FROM region", "region").data


@query("SELECT [1, 2, 3] AS a, CAST(3 AS BIGINT) AS n")
def shim_literals(spark, sf_dir):
    """Array literals and settings that choose what a bare set operation means."""
    sql = "SELECT [1, 2, 3] AS a, count() AS n FROM (SELECT 1 AS x UNION SELECT 1 UNION SELECT 2) SETTINGS union_default_mode = 'ALL'"
    return Engine(spark).query(sql).data


@query("SELECT vec_id, CAST(unnest(range(len(embedding))) AS INT) AS pos, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings")
def array_explode(spark, sf_dir):
    return N.flatten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding").withColumn("value", F.col("value").cast("double"))


@query("SELECT event_id, event_type, CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS INT) AS idx FROM events")
def discriminator_index(spark, sf_dir):
    return N.index_in_group(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", "event_id")


@query("SELECT CAST(CASE WHEN value < 10 THEN 0 ELSE 1 END AS TINYINT) AS d, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def discriminator_counts(spark, sf_dir):
    union = N.tagged([(F.col("value") < 10, F.col("value")), (F.lit(True), F.floor("value"))], ["double", "long"])
    return table(spark, sf_dir, "events").select(union["d"].alias("d")).groupBy("d").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_type AS name, CASE WHEN event_type IN ('click', 'view') THEN round(sum(value), 4) ELSE round(arg_max(value, event_id), 4) END AS value, max(value) AS peak FROM events GROUP BY event_type""")
def gauge_counter_fold(spark, sf_dir):
    from ..session import fold_events

    kind = F.when(F.col("event_type").isin("click", "view"), "increment").otherwise("gauge")
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("name"), kind.alias("kind"), "value", F.col("event_id").alias("seq"))
    return fold_events(events).withColumn("value", F.round("value", 4))


@query("SELECT d.doc_id, coalesce(quality, 0) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def coerce_null_default(spark, sf_dir):
    both = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return both.select("doc_id", C.coerce(F.col("quality"), "Int32").alias("quality"))


@query("SELECT doc_id, toxic = 1 AS toxic FROM labels")
def coerce_bool_string(spark, sf_dir):
    text = F.when(F.col("toxic") == 1, "TRUE").otherwise("0")
    return table(spark, sf_dir, "labels").select("doc_id", C.coerce(text, "Bool").alias("toxic"))


@query("SELECT o_orderkey, o_totalprice AS f, CAST(floor(o_totalprice) AS BIGINT) AS i, CAST(o_orderkey % 200 AS SMALLINT) AS u8, CAST(o_orderkey AS DECIMAL(20,0)) AS u64, CAST(o_orderkey AS VARCHAR) AS i128 FROM orders")
def coerce_numbers(spark, sf_dir):
    o, text = table(spark, sf_dir, "orders"), F.concat(F.lit(" "), F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", C.coerce(F.col("o_totalprice").cast("string"), "Float64").alias("f"), C.coerce(F.floor("o_totalprice").cast("string"), "Int64").alias("i"), C.coerce((F.col("o_orderkey") % 200).cast("string"), "UInt8").alias("u8"), C.coerce(text, "UInt64").alias("u64"), C.coerce(text, "Int128").alias("i128"))


@query("""SELECT c_custkey, '10.' || (c_custkey // 65536) % 256 || '.' || (c_custkey // 256) % 256 || '.' || c_custkey % 256 AS ip, 167772160 + c_custkey AS ip_number,
                 substr(md5(c_name), 1, 8) || '-' || substr(md5(c_name), 9, 4) || '-' || substr(md5(c_name), 13, 4) || '-' || substr(md5(c_name), 17, 4) || '-' || substr(md5(c_name), 21, 12) AS id,
                 '2001:0db8:0000:0000:0000:0000:0000:' || lpad(lower(to_hex(c_custkey % 65536)), 4, '0') AS ip6 FROM customer""")
def coerce_addresses(spark, sf_dir):
    k = F.col("c_custkey")
    v4 = F.concat_ws(".", F.lit("10"), (F.floor(k / 65536) % 256).cast("string"), (F.floor(k / 256) % 256).cast("string"), (k % 256).cast("string"))
    v6 = F.concat(F.lit("2001:DB8::"), F.hex(k % 65536))
    rows = table(spark, sf_dir, "customer").select(k, C.to_ipv4(v4).alias("ip"), C.to_uuid(F.upper(F.md5("c_name"))).alias("id"), F.lower(C.to_ipv6(v6)).alias("ip6"))
    return rows.withColumn("ip_number", C.ipv4_number(F.col("ip")))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'part' END AS e, CAST(o_orderdate AS DATE) AS d, date_trunc('second', o_orderdate) AS t, CAST(epoch_us(o_orderdate) AS BIGINT) * 1000 + 789 AS ticks, o_orderdate AS back FROM orders")
def coerce_times(spark, sf_dir):
    enum = C.coerce(F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "open").otherwise("3"), "Enum8('done' = 1, 'open' = 2, 'part' = 3)")
    at = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    ticks = C.coerce(F.concat(at, F.lit("789")), "DateTime64(9)")
    back = C.ticks_to_timestamp(ticks, 9, closest=True).cast("timestamp_ntz")
    return table(spark, sf_dir, "orders").select("o_orderkey", enum.alias("e"), C.coerce(F.col("o_orderdate").cast("date").cast("string"), "Date").alias("d"), C.coerce(at, "DateTime").alias("t"), ticks.alias("ticks"), back.alias("back"))


@query("SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS s FROM events")
def epoch_floor(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.unix_seconds(C.to_timestamp(F.col("ts").cast("string")).cast("timestamp")).alias("s"))


@query("SELECT c_custkey, c_name AS name, c_custkey % 3 = 0 AS third, '' AS missing, list_value(c_custkey, c_custkey + 1) AS pair FROM customer")
def row_transpose(spark, sf_dir):
    """Row objects by name, with unknown, missing and null keys, as columns."""
    from ..session import from_objects

    rows = [{"c_custkey": r["c_custkey"], "name": r["c_name"], "third": str(r["c_custkey"] % 3 == 0), "other": 1, "missing": None, "pair": [r["c_custkey"], r["c_custkey"] + 1]} for r in table(spark, sf_dir, "customer").toLocalIterator()]
    return from_objects(spark, [("c_custkey", "Int64"), ("name", "String"), ("third", "Bool"), ("missing", "String"), ("pair", "Array(Int64)")], rows)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_path(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", N.json_path(F.col("props"), "$.k", "bigint").alias("k"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS nope FROM events")
def variant_path(spark, sf_dir):
    v = C.coerce(F.col("props"), "JSON")
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"), F.try_variant_get(v, "$.nope", "string").alias("nope"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'STRING' ELSE 'OBJECT<a: BIGINT>' END AS kind FROM events")
def dynamic_inference(spark, sf_dir):
    text = F.when(F.col("event_id") % 3 == 0, F.col("event_id").cast("string")).when(F.col("event_id") % 3 == 1, "a b").otherwise('{"a": 1}')
    return table(spark, sf_dir, "events").select("event_id", F.schema_of_variant(C.coerce(text, "Dynamic")).alias("kind"))


@query("SELECT event_id, [event_type, 'n'] AS keys, [value, CAST(user_id AS DOUBLE)] AS vals FROM events")
def map_roundtrip(spark, sf_dir):
    """Maps as entries and back: written as blocks, read again, and taken apart."""
    from ..sources import blocks

    m = table(spark, sf_dir, "events").select("event_id", F.create_map("event_type", "value", F.lit("n"), F.col("user_id").cast("double")).alias("m"))
    columns = [("event_id", "Int64"), ("m", "Map(String, Float64)")]
    back = blocks.from_blocks(blocks.to_blocks(m, columns), columns)
    return back.select("event_id", F.map_keys("m").alias("keys"), F.map_values("m").alias("vals"))


LINEITEM = [("l_orderkey", "UInt64"), ("l_linenumber", "UInt8"), ("l_quantity", "Float64"), ("l_returnflag", "LowCardinality(String)"), ("l_shipdate", "DateTime64(6)"), ("l_tax", "Nullable(Float64)"), ("l_comment", "Tuple(Int64, String)")]


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate, CASE WHEN l_linenumber > 2 THEN l_tax END AS l_tax, l_partkey AS part, l_linestatus AS status FROM lineitem")
def block_roundtrip(spark, sf_dir):
    """The whole table as compressed binary blocks, and back."""
    from ..sources import blocks

    rows = table(spark, sf_dir, "lineitem").withColumns({"l_tax": F.when(F.col("l_linenumber") > 2, F.col("l_tax")), "l_comment": F.struct(F.col("l_partkey").alias("_1"), F.col("l_linestatus").alias("_2")), "l_orderkey": F.col("l_orderkey").cast("decimal(20,0)")})
    back = blocks.from_blocks(blocks.to_blocks(rows, LINEITEM, "lz4"), LINEITEM, framed=True)
    return back.select(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("int").alias("l_linenumber"), "l_quantity", "l_returnflag", "l_shipdate", "l_tax", F.col("l_comment._1").alias("part"), F.col("l_comment._2").alias("status"))


@query("SELECT CAST(1000 AS BIGINT) AS n, CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS made")
def random_roundtrip(spark, sf_dir):
    """A random table of a random structure as blocks and back: no row is lost or made, by canonical hash."""
    from ..functions.types import structure
    from ..sources import blocks
    from ..sources.random_data import random_structure, random_table

    text = random_structure(8, 5)
    df, columns = random_table(spark, text, 1000, 3), [(n, str(t)) for n, t in structure(text)]
    back = blocks.from_blocks(blocks.to_blocks(df, columns), columns)
    lost, made = N.differences(df, back)
    return back.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(lost).cast("long").alias("lost"), F.lit(made).cast("long").alias("made"))


@query("SELECT 'o_totalprice' AS name UNION ALL SELECT 'o_orderstatus'")
def column_differences(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    changed = o.withColumns({"o_totalprice": F.col("o_totalprice") + F.when(F.col("o_orderkey") == 1, 1).otherwise(0), "o_orderstatus": F.lower("o_orderstatus")})
    return spark.createDataFrame([(c,) for c in N.differing_columns(o, changed)], "name string")


@query("SELECT c_name, row_number() OVER (ORDER BY c_name DESC) - 1 AS row FROM customer")
def row_numbers(spark, sf_dir):
    return N.row_numbers(table(spark, sf_dir, "customer").select("c_name"), [F.desc("c_name")])


@query("SELECT CAST(count(*) AS BIGINT) AS read_rows, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS result_rows, 100 AS percent FROM orders")
def progress(spark, sf_dir):
    r = engine_query(spark, sf_dir, "SELECT o_orderkey FROM orders WHERE o_orderstatus || '' = 'F'", "orders")
    r.collect()
    p = r.progress
    return spark.createDataFrame([(p.read_rows, p.result_rows, p.percent)], "read_rows long, result_rows long, percent int")


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT n_nationkey + 100, n_name || chr(9) || '\\', NULL FROM nation")
def tsv_roundtrip(spark, sf_dir):
    """Tab-separated text with tabs, backslashes and nulls, parsed strictly."""
    from ..functions.types import structure
    from ..sources.formats import _escaped, parse_text

    n = table(spark, sf_dir, "nation")
    odd = n.unionByName(n.select((F.col("n_nationkey") + 100).alias("n_nationkey"), F.concat("n_name", F.lit("\t\\")).alias("n_name"), F.lit(None).cast("int").alias("n_regionkey")))
    lines = odd.select(F.concat_ws("\t", F.col("n_nationkey").cast("string"), _escaped(F.col("n_name")), F.coalesce(F.col("n_regionkey").cast("string"), F.lit("\\N"))).alias("v")).collect()
    return parse_text(spark, "".join(r["v"] + "\n" for r in lines), "TabSeparated", structure("n_nationkey Int32, n_name String, n_regionkey Nullable(Int32)"))


@query("SELECT date_trunc('hour', ts) AS start, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def streaming_hourly(spark, sf_dir):
    """An event-time aggregate that ran as a stream over the table's files."""
    from ..streaming.windows import hourly_from_files

    return hourly_from_files(spark, f"{sf_dir}/events.parquet")


@query("SELECT user_id, min(ts) AS start, CAST(count(*) AS BIGINT) AS n FROM (SELECT user_id, ts, sum(CASE WHEN d IS NULL OR d >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d FROM events) x) y GROUP BY user_id, s")
def session_windows(spark, sf_dir):
    from ..streaming.windows import sessions as session_window

    return session_window(table(spark, sf_dir, "events"))


@query("SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW), 4) AS s FROM events")
def window_range_frame(spark, sf_dir):
    sql = "SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW), 4) AS s FROM events"
    return engine_query(spark, sf_dir, sql, "events").data


@query("SELECT event_type, true AS near FROM events GROUP BY event_type")
def approximate_distinct(spark, sf_dir):
    sql = "SELECT event_type, abs(approx_count_distinct(user_id, 0.01) - count(DISTINCT user_id)) <= 0.05 * count(DISTINCT user_id) + 1 AS near FROM events GROUP BY event_type"
    return engine_query(spark, sf_dir, sql, "events").data


@query("SELECT p_partkey, p_retailprice * 2 AS twice FROM part")
def registered_function(spark, sf_dir):
    """A function of pandas series, registered with an engine and called in its SQL."""
    engine = Engine(spark)
    engine.register("twice", lambda x: x * 2, "double")
    return engine.query("SELECT p_partkey, twice(p_retailprice) AS twice FROM part", external_tables={"part": table(spark, sf_dir, "part")}).data
