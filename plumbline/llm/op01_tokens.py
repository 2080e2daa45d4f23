"""Token counts: a map-side two-tier lookup of pre-token lengths.

A unit is a word with the one space before it. Where a space stands between two characters that are not white space,
a byte-level pre-tokenizer always cuts before it, so a text's count is the sum of its units' counts. The first tier is
a compact hash table of the most frequent units, gathered from all documents as a bounded summary of each task and
broadcast; the second tier is a bounded cache in each Python worker, filled by encoding what the first tier misses.
No unit of a text is shuffled. Runs with other white space are encoded as they are, without a cache.

Defined results: a null text is empty and has no tokens; texts may be of any length (a unit of over UNIT_CHARS
characters is encoded, never cached); repeated rows are counted each; an empty table gives an empty result; columns of
the input are kept, and those added here replace any of the same name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import forget, text_or_empty, written

#: A unit is frequent from one in so many on, so that the broadcast table can't have more rows; rows of a task's summary;
#: entries of a worker's cache; characters of a cached unit.
FREQUENT, TASK_SUMMARY, CACHE, UNIT_CHARS = 200_000, 4_096, 400_000, 64
_IRREGULAR = 1 << 50


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most frequent units of a task's texts and their counts."""
    counts: Counter = Counter()
    for batch in batches:
        units = pc.list_flatten(pc.split_pattern(pc.fill_null(batch.column(0), ""), " "))
        seen = pc.value_counts(units)
        top = pc.select_k_unstable(pa.table({"u": seen.field("values"), "n": seen.field("counts")}), TASK_SUMMARY, [("n", "descending")])
        part = pa.table({"u": seen.field("values"), "n": seen.field("counts")}).take(top)
        counts.update(dict(zip(part["u"].to_pylist(), part["n"].to_pylist(), strict=True)))
        if len(counts) > 8 * TASK_SUMMARY:
            counts = Counter(dict(counts.most_common(4 * TASK_SUMMARY)))
    best = [(u, n) for u, n in counts.most_common(TASK_SUMMARY) if len(u) <= UNIT_CHARS and not _irregular(u)]
    yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())], ["unit", "n"])


def _irregular(unit: str) -> bool:
    return not unit or unit[0].isspace() or unit[-1].isspace()


class _Lengths(dict):
    """Units' token counts, without the space before them; encodes what it doesn't have."""

    def __init__(self, tokenizer, first: dict[str, int]):
        super().__init__(first)
        self.encode = tokenizer.encode
        self.most = len(first) + CACHE

    def __missing__(self, unit: str) -> int:
        if _irregular(unit):
            return _IRREGULAR
        n = len(self.encode(" " + unit, add_special_tokens=False).ids)
        if len(unit) <= UNIT_CHARS and len(self) < self.most:
            self[unit] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        first, *rest = text.split(" ")
        if first and not first[-1].isspace():
            total = sum(map(self.__getitem__, rest))
            if total < _IRREGULAR:
                return total + len(self.encode(first, add_special_tokens=False).ids)
        return self._count_runs([first, *rest])

    def _count_runs(self, pieces: list[str]) -> int:
        """For texts with other white space beside a space: what it touches is encoded in one run."""
        total, run = 0, [pieces[0]]
        is_first = True

        def closed() -> int:
            if len(run) == 1 and not is_first:
                n = self[run[0]]
                if n < _IRREGULAR:
                    return n
            return len(self.encode(("" if is_first else " ") + " ".join(run), add_special_tokens=False).ids)

        for before, piece in zip(pieces, pieces[1:], strict=False):
            if before and piece and not before[-1].isspace() and not piece[0].isspace():
                total += closed()
                run, is_first = [piece], False
            else:
                run.append(piece)
        return total + closed()


_WORKER: dict[tuple, _Lengths] = {}


def _lengths(key: str, spec: str, first: dict[str, int]) -> _Lengths:
    """This Python worker's cache, kept between tasks."""
    if (found := _WORKER.get(key)) is None:
        _WORKER.clear()
        found = _WORKER[key] = _Lengths(make_tokenizer(spec), first)
    return found


def make_tokenizer(spec: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def frequent_units(texts: DataFrame) -> list[str]:
    """Units that are one in FREQUENT or more of all units that the tasks' summaries count: FREQUENT at most."""
    rows = written(texts.mapInArrow(_summary, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n")), "units")
    total = rows.agg(F.sum("n").alias("n")).first()["n"] or 0
    found = [r["unit"] for r in rows.filter(F.col("n") * FREQUENT >= total).select("unit").collect()]
    forget(rows)
    return found


def count_tokens(df: DataFrame, tokenizer_json: str, text: str = "text") -> DataFrame:
    """df with n_tokens; tokenizer_json is the content of a byte-level BPE file of the tokenizers library."""
    spark = df.sparkSession
    tokenizer = make_tokenizer(tokenizer_json)
    units = frequent_units(df.select(text_or_empty(text).alias("text")))
    first = {u: len(tokenizer.encode(" " + u, add_special_tokens=False).ids) for u in units}
    shared = spark.sparkContext.broadcast((tokenizer_json, first))
    key = f"{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}"
    kept = [c for c in df.columns if c != "n_tokens"]
    source = df.select(*kept, text_or_empty(text).alias("__text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _lengths(key, *shared.value)
        for batch in batches:
            counts = pa.array([lengths.count(t) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], counts], [*batch.schema.names[:-1], "n_tokens"])

    schema = T.StructType([*source.schema.fields[:-1], T.StructField("n_tokens", T.LongType())])
    return source.mapInArrow(counted, schema)


def op1_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    slim = docs.withColumn("n_bytes", F.octet_length(text_or_empty("text")).cast("long"))
    out = count_tokens(slim, spec)
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))
