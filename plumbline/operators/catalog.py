"""The query library: each inventory construct on the driver's tables, with its oracle in ANSI SQL.

Most are one SQL statement over named tables; those that a statement can't express are functions in library.py. Where
Spark's and the oracle's types or functions differ, both texts are given.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A statement whose tables are read where it names them; nothing is registered in the session."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if re.search(rf"\b{t}\b", text)}
    return spark.sql(re.sub(rf"\b({'|'.join(used)})\b", r"{\1}", text), **used) if used else spark.sql(text)


def statement(name: str, text: str, oracle: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_sql(spark, sf_dir, text)

    QUERIES[name] = run
    ORACLES[name] = oracle or text


def query(oracle: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


# Scans, projection, filters
statement("scan_project", "SELECT c_custkey AS id, c_name AS name, c_acctbal + 1 AS balance, 'x' AS tag FROM customer")
statement("filter_eq", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
statement("filter_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderkey IN (1, 2, 3, 50, 999)")
statement("filter_mod", "SELECT o_orderkey, o_orderkey % 7 AS m FROM orders WHERE o_orderkey % 7 = 3")
statement("between_like", "SELECT p_partkey, p_name FROM part WHERE p_size BETWEEN 5 AND 9 AND p_name LIKE '%ring%'")
# Joins
statement("join_inner_group_order", "SELECT c_mktsegment, o_orderpriority, CAST(count(*) AS BIGINT) AS n_orders, round(sum(o_totalprice), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment, o_orderpriority ORDER BY 1, 2")
statement("join_left_expr", "SELECT o_orderkey, r_name FROM orders LEFT JOIN region ON o_custkey % 7 = r_regionkey")
statement("join_chain", "SELECT n_name, r_name, CAST(count(*) AS BIGINT) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name")
statement("join_full", "SELECT c_custkey, s_suppkey FROM (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0) a FULL JOIN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0) b ON c_custkey = s_suppkey")
statement("join_right", "SELECT n_nationkey, s_suppkey FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey")
statement("join_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
statement("join_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)")
statement("join_cross", "SELECT a.r_name AS a, b.r_name AS b FROM region a CROSS JOIN region b")
statement("join_any", "SELECT c_custkey, o_orderkey FROM customer JOIN (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey) x ON c_custkey = o_custkey")
# Aggregation
statement("agg_global", "SELECT round(sum(l_quantity), 2) AS q, max(l_extendedprice) AS hi, min(l_extendedprice) AS lo, round(avg(l_discount), 6) AS d FROM lineitem")
statement("agg_empty", "SELECT CAST(count(*) AS BIGINT) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_quantity < 0")
statement("agg_group", "SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY l_returnflag, l_linestatus")
statement("agg_group_expr", "SELECT CAST(year(l_shipdate) AS INT) AS y, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY year(l_shipdate)")
statement("agg_having", "SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12")
statement("count_distinct", "SELECT event_type, CAST(count(DISTINCT user_id) AS BIGINT) AS users FROM events GROUP BY event_type")
statement("distinct", "SELECT DISTINCT p_brand, p_type FROM part")
statement("rollup", "SELECT n_regionkey, n_name, CAST(count(*) AS BIGINT) AS n FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY ROLLUP (n_regionkey, n_name)")
statement("cube", "SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
statement("agg_filter", "SELECT l_returnflag, CAST(count(*) FILTER (WHERE l_discount > 0.05) AS BIGINT) AS n FROM lineitem GROUP BY l_returnflag")
statement("agg_stats", "SELECT event_type, round(stddev_samp(value), 6) AS sd, round(var_pop(value), 6) AS v, round(corr(value, user_id), 6) AS r FROM events GROUP BY event_type")
statement("agg_quantile", "SELECT event_type, round(percentile(value, 0.5), 6) AS med FROM events GROUP BY event_type", "SELECT event_type, round(quantile_cont(value, 0.5), 6) AS med FROM events GROUP BY event_type")
statement("agg_argmax", "SELECT user_id, max_by(event_id, ts) AS last_event FROM events GROUP BY user_id", "SELECT user_id, arg_max(event_id, ts) AS last_event FROM events GROUP BY user_id")
statement("agg_bits", "SELECT bit_and(o_orderkey) AS a, bit_or(o_orderkey) AS o, bit_xor(o_orderkey) AS x FROM orders")
statement("pivot", "SELECT user_id, CAST(count(CASE WHEN event_type = 'click' THEN 1 END) AS BIGINT) AS clicks, CAST(count(CASE WHEN event_type = 'error' THEN 1 END) AS BIGINT) AS errors FROM events GROUP BY user_id")
# Sort, limits, set operations, subqueries
statement("order_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
statement("limit_offset", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 10 OFFSET 100")
statement("except_two_way", "SELECT 'a' AS side, o_custkey AS k FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) x UNION ALL SELECT 'b', c_custkey FROM (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0 EXCEPT SELECT o_custkey FROM orders) y")
statement("except_all", "SELECT user_id FROM events EXCEPT ALL SELECT c_custkey FROM customer")
statement("intersect", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
statement("union_all", "SELECT c_name AS n FROM customer UNION ALL SELECT s_name FROM supplier")
statement("union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
statement("scalar_subquery", "SELECT o_orderkey, (SELECT max(c_acctbal) FROM customer) AS top FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.9 FROM orders)")
statement("derived_table", "SELECT s, CAST(count(*) AS BIGINT) AS n FROM (SELECT substr(c_mktsegment, 1, 2) AS s FROM customer WHERE c_acctbal > 0) x GROUP BY s")
statement("correlated_subquery", "SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT 1.5 * avg(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)")
statement("cte", "WITH big AS (SELECT o_custkey, sum(o_totalprice) AS t FROM orders GROUP BY o_custkey), top AS (SELECT * FROM big WHERE t > 3000000) SELECT c_name, round(t, 2) AS t FROM top JOIN customer ON o_custkey = c_custkey")
statement("recursive_cte", "WITH RECURSIVE r(n, f) AS (SELECT 1, CAST(1 AS BIGINT) UNION ALL SELECT n + 1, f * (n + 1) FROM r WHERE n < 15) SELECT n, f FROM r")
# Windows
statement("window_rank", "SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER w AS rk, dense_rank() OVER w AS dr FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)", "SELECT o_orderkey, CAST(row_number() OVER w AS INT) AS rn, CAST(rank() OVER w AS INT) AS rk, CAST(dense_rank() OVER w AS INT) AS dr FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
statement("window_lag_lead", "SELECT event_id, lag(value) OVER w AS before, lead(value, 2, 0.0) OVER w AS after, first_value(value) OVER w AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)", "SELECT event_id, lag(value) OVER w AS before, lead(value, 2, 0.0) OVER w AS after, first_value(value) OVER w AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
statement("window_frame", "SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS s FROM events")
statement("top_k_per_group", "SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) x WHERE rn <= 2")
statement("window_share", "SELECT s_suppkey, round(s_acctbal / sum(abs(s_acctbal)) OVER (PARTITION BY s_nationkey), 8) AS share FROM supplier")
statement("ntile", "SELECT p_partkey, ntile(4) OVER (ORDER BY p_retailprice, p_partkey) AS q FROM part", "SELECT p_partkey, CAST(ntile(4) OVER (ORDER BY p_retailprice, p_partkey) AS INT) AS q FROM part")
# Scalar functions
statement("date_functions", "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, CAST(quarter(o_orderdate) AS INT) AS q, datediff(o_orderdate, DATE '1992-01-01') AS d FROM orders", "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, CAST(quarter(o_orderdate) AS INT) AS q, CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS INT) AS d FROM orders")
statement("date_trunc_month", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1")
statement("string_functions", "SELECT c_custkey, upper(c_mktsegment) AS u, CAST(length(c_name) AS INT) AS n, substr(c_name, 10) AS tail, replace(c_name, 'Customer#', '') AS bare, trim(c_mktsegment) AS t FROM customer")
statement("regex_functions", "SELECT p_partkey, regexp_extract(p_brand, '#(\\\\d+)', 1) AS num FROM part WHERE p_name RLIKE '^r.*t$'", "SELECT p_partkey, regexp_extract(p_brand, '#(\\d+)', 1) AS num FROM part WHERE regexp_matches(p_name, '^r.*t$')")
statement("math_functions", "SELECT p_partkey, round(sqrt(p_retailprice), 6) AS s, round(ln(p_retailprice), 6) AS l, CAST(floor(p_retailprice) AS BIGINT) AS f, CAST(ceil(p_retailprice) AS BIGINT) AS c FROM part")
statement("null_functions", "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'F'), 'none') AS s FROM orders")
statement("array_functions", "SELECT vec_id, size(embedding) AS n, round(CAST(embedding[0] AS DOUBLE), 5) AS first FROM embeddings", "SELECT vec_id, CAST(len(embedding) AS INT) AS n, round(CAST(embedding[1] AS DOUBLE), 5) AS first FROM embeddings")
# Reshaping and coercion
statement("tumbling_window", "SELECT CAST(window(ts, '1 hour').start AS TIMESTAMP_NTZ) AS start, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY window(ts, '1 hour'), event_type", "SELECT date_trunc('hour', ts) AS start, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")

from . import library  # noqa: E402, F401  registers its functions here
