"""Sharding by histogram sort.

Rows are ordered by a 128-bit key, whose last 32 bits tell equal rows apart by their place in the input; splitters
between shards are found by counting, across all partitions, the exact bytes below candidate key boundaries. Each round looks only inside the key intervals that still hold a splitter and
cuts them into 2**16 probes, until an interval holds no more than the tolerance or a single key. The rows are then
exchanged once.

Defined results: a null text has no bytes (its size is the overhead only); null keys sort first; repeated rows may
fall on either side of a splitter, and get slots in no set order; an empty table gives an empty result; columns of the input are kept, and the names this operator adds replace any of
the same name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from .common import text_or_empty, written

PROBE_BITS = 16
#: A shard's rows are numbered in this many parts for each so many rows, so that no task numbers a whole shard.
ROWS_PER_PART, LEAST_PARTS = 500_000, 16


#: Digits of a key: 32 bits of high, 64 of low, 32 of a row's place.
DIGITS = 8


def _key_parts(high: Column, low: Column, place: Column) -> list[Column]:
    """The key as 16-bit digits, most significant first; low in signed order."""
    flipped = low.bitwiseXOR(F.lit(-(1 << 63)))
    digits = [F.shiftright(high, 16), high.bitwiseAND(F.lit(0xFFFF))]
    digits += [F.shiftrightunsigned(flipped, s).bitwiseAND(F.lit(0xFFFF)) for s in (48, 32, 16, 0)]
    digits += [F.shiftrightunsigned(place, s).bitwiseAND(F.lit(0xFFFF)) for s in (16, 0)]
    return [d.cast("int") for d in digits]


def find_splitters(keyed: DataFrame, shards: int, tolerance: float) -> list[tuple[int, ...]]:
    """Digit prefixes p_1 <= ... <= p_(shards-1): shard i takes the keys whose digits are at or above p_i and below p_(i+1).

    keyed has the columns size and d0..d7. At most 65,536 sums for each open interval come to the driver in a round,
    as columns, and at most shards - 1 intervals are open.
    """
    spark = keyed.sparkSession
    total = keyed.agg(F.sum("size").alias("s")).first()["s"] or 0
    goals = [total * i // shards for i in range(1, shards)]
    slack = max(1, int(tolerance * total / shards))
    found: dict[int, tuple[int, ...]] = {}
    open_at: dict[tuple[int, ...], tuple[int, list[int]]] = {(): (0, list(range(len(goals))))}
    for level in range(DIGITS):
        if not open_at:
            break
        prefixes = list(open_at)
        rows = keyed.withColumn("_p", F.lit(0))
        if level:
            schema = T.StructType([*(T.StructField(f"d{i}", T.IntegerType()) for i in range(level)), T.StructField("_p", T.IntegerType())])
            wanted = spark.createDataFrame([(*p, k) for k, p in enumerate(prefixes)], schema)
            rows = keyed.join(F.broadcast(wanted), [f"d{i}" for i in range(level)])
        counted = rows.groupBy("_p", f"d{level}").agg(F.sum("size").alias("s")).toArrow()
        of, digit, size = (counted.column(k).to_numpy() for k in range(3))
        order = np.lexsort((digit, of))
        of, digit, size = of[order], digit[order], size[order]
        still: dict[tuple[int, ...], tuple[int, list[int]]] = {}
        for k, prefix in enumerate(prefixes):
            below, which = open_at[prefix]
            part = slice(*np.searchsorted(of, (k, k + 1)))
            digits, upto = digit[part], below + np.cumsum(size[part])
            for g in which:
                at = int(np.searchsorted(upto, goals[g]))
                if at == len(upto):
                    found[g] = (*prefix, 1 << PROBE_BITS)  # past the last key of this interval
                    continue
                over = int(upto[at])
                under = int(upto[at - 1]) if at else below
                before, after = goals[g] - under, over - goals[g]
                if level == DIGITS - 1 or over - under <= slack or min(before, after) <= slack // 4:
                    found[g] = (*prefix, int(digits[at]) + (before > after))
                else:
                    still.setdefault((*prefix, int(digits[at])), (under, []))[1].append(g)
        open_at = still
    return [found[g] for g in range(len(goals))]


def _shard_of(splitters: list[tuple[int, ...]]) -> Column:
    """The number of splitters at or below a row's key, by binary search in nested conditions."""

    def at_or_above(p: tuple[int, ...]) -> Column:
        out = F.lit(True)
        for i in reversed(range(len(p))):
            d = F.col(f"d{i}")
            out = (d > p[i]) | ((d == p[i]) & out)
        return out

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(at_or_above(splitters[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(splitters))


def shard(df: DataFrame, shards: int, size: Column, high: Column, low: Column, tolerance: float = 0.002) -> DataFrame:
    """df with shard (0 to shards - 1, near equal sums of size) and slot (0, 1, ... within each shard). df is written once.

    high gives a key's upper 32 bits (a non-negative long), low its lower 64 (a long): equal contents next to each
    other, and a third of all rows with the same content are still divided by low.
    """
    kept = [c for c in df.columns if c not in ("shard", "slot", "size")]
    full = df.select(*kept, F.coalesce(size, F.lit(0)).cast("long").alias("size"), F.coalesce(high, F.lit(0)).cast("long").alias("_high"), F.coalesce(low, F.lit(-(1 << 63))).cast("long").alias("_low"))
    # Places hold for a table that is written; computed anew, they could differ from one pass to the next.
    full = written(full.withColumn("_place", F.xxhash64(F.monotonically_increasing_id())), "shard-rows")
    narrow = full.select("size", "_high", "_low", "_place")
    digits = [d.alias(f"d{i}") for i, d in enumerate(_key_parts(F.col("_high"), F.col("_low"), F.col("_place")))]
    splitters = find_splitters(narrow.select("size", *digits), shards, tolerance)
    shard_of = _shard_of(splitters).cast("int").alias("shard")
    rows = narrow.count()
    parts = max(LEAST_PARTS, -(-rows // (shards * ROWS_PER_PART)))
    part_of = F.pmod(F.xxhash64("_place"), F.lit(parts)).cast("int").alias("_part")
    # Rows of each part of each shard, in shards * parts sums; a running sum of them is where a part's slots begin.
    sums = narrow.select("*", *digits).select(shard_of, part_of).groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("n")).collect()
    starts, at = [], {}
    for s, p, n in sorted((r["shard"], r["_part"], r["n"]) for r in sums):
        starts.append((s, p, at.get(s, 0)))
        at[s] = at.get(s, 0) + n
    begin = df.sparkSession.createDataFrame(starts, "shard int, _part int, _start long")
    placed = full.select("*", *digits).select(*kept, "size", "_low", "_high", "_place", shard_of, part_of)
    # The one exchange of the rows.
    order = Window.partitionBy("shard", "_part").orderBy("_high", "_low", "_place")
    placed = placed.withColumn("_n", F.row_number().over(order))
    placed = placed.join(F.broadcast(begin), ["shard", "_part"], "left")
    return placed.select(*kept, "size", "shard", (F.col("_start") + F.col("_n") - 1).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Writes each shard to a folder of its own, shard=N; several files to a large one."""
    sharded.write.partitionBy("shard").parquet(path)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents in 40 shards of near equal bytes, keyed by the text's CRC-32, then doc_id, so that copies stay together."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = text_or_empty("text")
    slim = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("bytes"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    out = shard(slim, 40, F.col("bytes"), F.col("text_crc32"), F.col("doc_id"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
