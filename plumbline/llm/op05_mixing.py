"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source is to be copied target / source size times: a whole number of copies, and one more with a
probability. Pivotal rounding pairs two documents and moves mass (words) between them, at random and without bias,
until one of them has a probability of 0 or 1; the other goes on. The words taken from a source thus stay what they
should be, but for one document. Pairs are made within bins of about BIN documents; what is left of each bin is
combined in the next level's bins, up to one bin a source.

Defined results: a null text has no words and is taken 0 words; of n rows that are equal in all columns, the whole part
of n times the probability get one more copy, and the rest is rounded as one document's (so repeated rows and null ids
are no larger unit than any other); a null source is a source, last in order; choices depend on the rows' contents and
the seed only, so reruns agree; an empty table gives an empty result; columns of the input are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import n_words, text_or_empty, uniform, written

#: Documents in a bin, on average. An average bin of the last level is smaller.
BIN = 32
WEIGHTS = (3.0, 1.0, 2.0)
#: Copies of one row that a task makes at a time.
COPIES = 4_096
_KEY = "struct<id:bigint,h:bigint,k:bigint,size:bigint,source:string,n:bigint,more:bigint>"


def targets(sizes: dict[str | None, int], weights: tuple[float, ...], share: float, most: float) -> dict[str | None, float]:
    """Words to take of each source: by weight, and where that is above most times its size, the excess reshared by weight."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    out = dict.fromkeys(order, 0.0)
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        sum_w = sum(weight[s] for s in free)
        out = {s: float(most * sizes[s]) if s in capped else left * weight[s] / sum_w for s in order}
        above = {s for s in free if out[s] > most * sizes[s]}
        if not above:
            return out
        capped |= above


def _pivot(units: Column) -> Column:
    """Folds an array of units (mass, key, p, u) to (carried unit, decided array of (key, x))."""
    unit_t = f"struct<mass:double,key:{_KEY},p:double,u:double>"
    done_t = f"array<struct<key:{_KEY},x:int>>"
    none = F.lit(None).cast(unit_t)
    start = F.struct(none.alias("carry"), F.array().cast(done_t).alias("done"))

    def unit(of: Column, p: Column) -> Column:
        return F.struct(of["mass"].alias("mass"), of["key"].alias("key"), p.alias("p"), of["u"].alias("u"))

    def fate(of: Column, x: int) -> Column:
        return F.array(F.struct(of["key"].alias("key"), F.lit(x).alias("x")))

    def step(state: Column, b: Column) -> Column:
        a, done = state["carry"], state["done"]
        up = F.least(a["mass"] * (1 - a["p"]), b["mass"] * b["p"])  # mass that can go from b to a
        down = F.least(a["mass"] * a["p"], b["mass"] * (1 - b["p"]))  # mass that can go from a to b
        to_a = b["u"] * (up + down) < down
        a_full = to_a & (a["mass"] * (1 - a["p"]) <= b["mass"] * b["p"])  # a gets its copy, b goes on with what it has
        b_empty = to_a & ~(a["mass"] * (1 - a["p"]) <= b["mass"] * b["p"])
        b_full = ~to_a & (b["mass"] * (1 - b["p"]) <= a["mass"] * a["p"])
        a_left = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(to_a, a["p"] + up / a["mass"]).otherwise(a["p"] - down / a["mass"])))
        b_left = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(to_a, b["p"] - up / b["mass"]).otherwise(b["p"] + down / b["mass"])))
        carry = F.when(a.isNull(), b).when(a_full, unit(b, b_left)).when(b_empty, unit(a, a_left)).when(b_full, unit(a, a_left)).otherwise(unit(b, b_left))
        more = F.when(a_full, fate(a, 1)).when(b_empty, fate(b, 0)).when(b_full, fate(b, 1)).otherwise(fate(a, 0))
        return F.struct(carry.alias("carry"), F.when(a.isNull(), done).otherwise(F.concat(done, more)).alias("done"))

    return F.aggregate(units, start, step)


def round_pivotal(units: DataFrame, per_source: int, seed: int) -> DataFrame:
    """units (key, mass above 0, p strictly between 0 and 1) with x, 0 or 1; per_source: units of the largest source."""
    level, decided, left = 0, [], units
    while True:
        bins = F.greatest(F.lit(1), F.ceil(F.col("_n") / BIN)).cast("long")
        bin_of = F.pmod(F.xxhash64("key.h", "key.k", F.lit(seed), F.lit(level)), bins)
        u = uniform(F.col("key.h"), F.col("key.k"), F.lit(seed + 1), F.lit(level))
        member = F.struct("mass", "key", "p", u.alias("u"))
        folded = left.groupBy("key.source", bin_of.alias("bin"), bins.alias("_n")).agg(F.sort_array(F.collect_list(member), asc=False).alias("units"))
        folded = written(folded.select("_n", _pivot(F.col("units")).alias("f")), f"pivot-{level}")
        decided.append(folded.select(F.explode("f.done").alias("d")).select("d.key", "d.x"))
        left = folded.filter(F.col("f.carry").isNotNull()).select("_n", "f.carry.key", "f.carry.mass", "f.carry.p")
        per_source, level = -(-per_source // BIN), level + 1
        if per_source <= 1:
            break
    last = left.select("key", (uniform(F.col("key.h"), F.col("key.k"), F.lit(seed + 2)) < F.col("p")).cast("int").alias("x"))
    for d in decided:
        last = last.unionByName(d)
    return last


def row_hashes(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of all of a row's columns, nulls told apart; equal rows have equal ones."""
    cells = [x for c in df.columns for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(F.lit(k), *cells) for k in (1, 2)]


def copies(df: DataFrame, source_col: str, size: Column, id_col: str | None = None, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 17) -> DataFrame:
    """One row for each different row of df, by its hashes h and k: id, source, size, n (rows), whole (copies of each row),
    more (how many of the n get one more), source_size and target (the source's).

    One row a source comes to the driver; sources are the mix's own parameters.
    """
    spark = df.sparkSession
    h, k = row_hashes(df)
    of_id = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    rows = df.select(of_id.alias("id"), h.alias("h"), k.alias("k"), F.col(source_col).cast("string").alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size"))
    units = written(rows.groupBy("h", "k", "id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-units")
    found = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum((F.col("size") > 0).cast("long")).alias("units")).collect()
    sizes = {r["source"]: r["size"] for r in found}
    goal = targets(sizes, weights, share, most) if sizes else {}
    ratio = {s: goal[s] / sizes[s] if sizes[s] else 0.0 for s in sizes}
    table = [(r["source"], r["size"], goal[r["source"]], int(ratio[r["source"]]), ratio[r["source"]] - int(ratio[r["source"]]), r["units"]) for r in found]
    plan = F.broadcast(spark.createDataFrame(table, "plan_source string, source_size long, target double, whole int, part double, _n long"))
    planned = units.join(plan, units["source"].eqNullSafe(F.col("plan_source")), "left").drop("plan_source")
    due = F.when(F.col("size") > 0, F.col("part") * F.col("n")).otherwise(0.0)
    planned = planned.withColumn("more", F.floor(due + 1e-9)).withColumn("p", due - F.col("more"))
    is_open = (F.col("p") > 1e-9) & (F.col("size") > 0)
    key = F.struct("id", "h", "k", "size", "source", "n", "more").alias("key")
    in_play = planned.filter(is_open).select("_n", key, F.col("size").cast("double").alias("mass"), "p")
    rounded = round_pivotal(in_play, max((r["units"] for r in found), default=0), seed)
    settled = planned.filter(~is_open).select(key, F.lit(0).alias("x"))
    x = rounded.unionByName(settled).select("key.*", "x")
    out = x.join(plan, x["source"].eqNullSafe(F.col("plan_source")), "left")
    return out.select("id", "h", "k", "source", "size", "n", F.when(F.col("size") > 0, F.col("whole")).otherwise(0).cast("long").alias("whole"), (F.col("more") + F.col("x")).alias("more"), "source_size", "target")


def repeated(df: DataFrame, times: Column, keys: list[str]) -> DataFrame:
    """df's rows as often as times says, numbered from 1 in _i; those of more than COPIES are dealt out before they are made."""
    named = df.withColumn("_times", times)
    few = named.filter(F.col("_times").between(1, COPIES)).withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    many = named.filter(F.col("_times") > COPIES).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_times") - 1) / COPIES))))
    first = F.col("_part") * COPIES
    many = many.repartition(*keys, "_part").withColumn("_i", F.explode(F.sequence(first + 1, F.least(first + COPIES, F.col("_times")))))
    return few.unionByName(many.drop("_part")).drop("_times")


def mix(df: DataFrame, source_col: str, size: Column, **options) -> DataFrame:
    """df's rows, each as often as the mix takes it. Equal rows are one before they are exchanged."""
    names = df.columns
    chosen = copies(df, source_col, size, **options).select(F.col("h").alias("_a"), F.col("k").alias("_b"), (F.col("n") * F.col("whole") + F.col("more")).alias("_copies")).filter("_copies > 0")
    h, k = row_hashes(df)
    once = df.select(F.struct(*names).alias("_row"), h.alias("_h"), k.alias("_k")).groupBy("_h", "_k").agg(F.first("_row").alias("_row"))
    both = once.join(chosen, (once["_h"] == chosen["_a"]) & (once["_k"] == chosen["_b"])).select("_row", "_h", "_k", "_copies")
    return repeated(both, F.col("_copies"), ["_h", "_k"]).select("_row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    slim = docs.select("doc_id", "source", n_words(text_or_empty("text")).alias("size"))
    out = repeated(copies(slim, "source", F.col("size"), "doc_id"), F.col("n"), ["h", "k"])
    taken = F.col("size") * (F.col("whole") + (F.col("_i") <= F.col("more")).cast("long"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"))
