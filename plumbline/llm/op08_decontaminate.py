"""Benchmark decontamination: passages of every text are queries against a BM25 inverted index of test items.

Items (long ones in segments) are the index's documents; document frequencies and the mean length are those of all
items. Impacts are divided by a segment's score for its own text, so a passage's score says how much of it the passage
holds, and one threshold fits all. Postings are lists of (segment, impact), in blocks of segments with their largest
impact (block-max WAND, on whole arrays): of a passage's terms, those of least bounds that can't reach the threshold
together never name a block (the pivot); a block that the others name goes on if the largest impacts of all the
passage's terms there reach the threshold, and only then its postings are scored. Every pair above the threshold is then
verified: 5-word shingles of the question, and where an item has an answer, the answer's words in the same passage.

Defined results: null and empty texts and items match nothing; an item of fewer than 5 words is one shingle; repeated
rows are judged each, repeated items too; an empty table, or no items, flags nothing; columns of the input are kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import written
from .shingles import FEW_BYTES, WORDS, distinct, flat_words, slices, sparing

#: Words of a half passage (a passage is two that follow each other), and of an item's segment.
HALF, SEGMENT = 64, 64
#: Share of an item's own score that a passage must reach to be verified, and share of its shingles to be flagged.
THRESHOLD, OVERLAP = 0.6, 0.8
#: Segments in a block of postings; words of items that are indexed and broadcast at a time, more are taken in turns.
BLOCK, WORDS_AT_ONCE = 8, 1_000_000
#: (passage, term, block) triples that are looked at together.
AT_ONCE = 1 << 20
K1, B = 1.2, 0.75
_TRIM = ".,;:!?\"'()[]{}«»“”„‘’…-"


def norm_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case words without punctuation around them; words of nothing else are left out."""
    flat, offsets = flat_words(pc.utf8_lower(pc.fill_null(texts, "")))
    flat = pc.utf8_trim(flat, characters=_TRIM)
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    return flat.filter(pa.array(real)), np.concatenate([[0], np.cumsum(real)])[offsets]


@dataclass
class Index:
    """Sorted terms with their bounds; blocks, by (term, block), with their bounds and where their postings begin; postings."""

    terms: pa.Array
    term_bound: np.ndarray
    term_blocks: np.ndarray
    block_key: np.ndarray
    block_bound: np.ndarray
    block_postings: np.ndarray
    segment: np.ndarray
    impact: np.ndarray
    n_blocks: int
    segment_item: list[int]
    items: list[tuple[int, list[str], list[str]]]

    @property
    def n_bytes(self) -> int:
        return self.terms.nbytes + sum(x.nbytes for x in vars(self).values() if isinstance(x, np.ndarray))


def segments(words: list[str]) -> list[list[str]]:
    return [words[max(0, min(at, len(words) - SEGMENT)) : at + SEGMENT] for at in range(0, len(words), SEGMENT)]


def build_index(items: list[tuple[int, str, str | None]], n: int | None = None, mean: float | None = None, df: dict[str, int] | None = None) -> Index:
    """items: (id, question, answer or None); n, mean, df: segments of all items, their mean length and how many have a term."""
    kept, parts, owner = [], [], []
    for item_id, question, answer in items:
        words = norm_words(pa.array([question or ""], pa.string()))[0].to_pylist()
        if words:
            own = segments(words)
            parts += own
            owner += [len(kept)] * len(own)
            kept.append((item_id, words, norm_words(pa.array([answer or ""], pa.string()))[0].to_pylist()))
    if df is None:
        df = Counter(t for p in parts for t in set(p))
        n, mean = len(parts), sum(map(len, parts)) / max(1, len(parts))
    terms = sorted({w for p in parts for w in p})
    place = {t: i for i, t in enumerate(terms)}
    rows = [(place[w], j, c) for j, p in enumerate(parts) for w, c in Counter(p).items()]
    term, segment, tf = (np.array(x, np.int64) for x in (zip(*rows, strict=True) if rows else ([], [], [])))
    often = np.array([df[t] for t in terms], float)
    idf = np.log1p((n - often + 0.5) / (often + 0.5))
    length = np.array([len(p) for p in parts], float)
    norm = K1 * (1 - B + B * length / max(1.0, mean))
    impact = idf[term] * tf * (K1 + 1) / (tf + norm[segment])
    impact = (impact / np.maximum(np.bincount(segment, impact, len(parts)), 1e-9)[segment]).astype(np.float32)
    order = np.lexsort((segment, term))
    term, segment, impact = term[order], segment[order], impact[order]
    n_blocks = -(-len(parts) // BLOCK)
    key = term * max(1, n_blocks) + segment // BLOCK
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    of_term = np.searchsorted(key[first] // max(1, n_blocks), np.arange(len(terms) + 1))
    block_bound = np.maximum.reduceat(impact, first) if len(first) else impact
    term_bound = np.maximum.reduceat(block_bound, of_term[:-1]) if len(terms) else impact
    return Index(pa.array(terms, pa.string()), term_bound, of_term, key[first], block_bound, np.append(first, len(key)), segment.astype(np.int32), impact, max(1, n_blocks), owner, kept)


def candidates(index: Index, flat: pa.Array, offsets: np.ndarray, threshold: float) -> set[tuple[int, int, int]]:
    """(text, first word of a passage in the batch, place of an item) for every passage that scores threshold or more."""
    found: set[tuple[int, int, int]] = set()
    if not len(flat) or not len(index.terms):
        return found
    least = threshold - 1e-4
    ids = pc.index_in(flat, index.terms)
    at = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
    term = ids.drop_null().to_numpy().astype(np.int64)
    # Halves are numbered through the batch; a text's halves start anew, and a gap stands between texts.
    halves = -(-np.diff(offsets) // HALF) + 1
    first_half = np.concatenate([[0], np.cumsum(halves)])
    text_of = np.searchsorted(offsets, at, side="right") - 1
    half = first_half[text_of] + (at - offsets[text_of]) // HALF
    vocabulary = len(index.terms)
    p_half, p_term = np.divmod(distinct(half * vocabulary + term), vocabulary)
    n_halves = int(first_half[-1])
    bound = np.bincount(p_half, index.term_bound[p_term], n_halves + 1)
    passage = np.flatnonzero(bound[:-1] + bound[1:] >= least)  # halves i and i + 1
    passage = np.setdiff1d(passage, first_half[1:] - 1, assume_unique=True)  # no passage begins in a gap
    starts = np.searchsorted(p_half, np.arange(n_halves + 2))
    for some in np.array_split(passage, max(1, -(-len(passage) // 4096))):
        if not len(some):
            continue
        sizes = starts[np.minimum(some + 2, n_halves + 1)] - starts[some]
        own = distinct(np.repeat(np.arange(len(some)), sizes) * vocabulary + p_term[_ranges(starts[some], sizes)])
        which, terms = np.divmod(own, vocabulary)
        for k, segment in _retrieved(index, which, terms, len(some), least):
            text = int(np.searchsorted(first_half, some[k], side="right") - 1)
            found.add((text, int(offsets[text] + (some[k] - first_half[text]) * HALF), index.segment_item[segment]))
    return found


def _retrieved(index: Index, which: np.ndarray, terms: np.ndarray, n: int, least: float) -> Iterator[tuple[int, int]]:
    """(passage, segment) of scores of least or more; a passage's distinct terms are in which and terms, sorted by passage."""
    bounds, n_blocks = index.term_bound[terms].astype(np.float64), index.n_blocks
    # A passage's terms from the least bound on; those whose sum stays below the threshold name no block.
    order = np.lexsort((bounds, which))
    summed = np.cumsum(bounds[order])
    begins = np.searchsorted(which, np.arange(n + 1))
    below = summed - (summed - bounds[order])[np.minimum(begins[:-1], len(order) - 1)][which[order]]
    named = order[below >= least]
    n_lists = index.term_blocks[terms[named] + 1] - index.term_blocks[terms[named]]
    ends = np.cumsum(n_lists)
    at = 0
    # Whole passages at a time: named is sorted by passage.
    while at < len(named):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, side="right")))
        stop = int(np.searchsorted(which[named], which[named[stop - 1]], side="right"))
        part, lists = named[at:stop], n_lists[at:stop]
        at = stop
        block = index.block_key[_ranges(index.term_blocks[terms[part]], lists)] % n_blocks
        pairs = distinct(np.repeat(which[part], lists) * n_blocks + block)
        for first in range(0, len(pairs), AT_ONCE >> 7):
            yield from _scored(index, pairs[first : first + (AT_ONCE >> 7)], terms, begins, least)


def _scored(index: Index, pairs: np.ndarray, terms: np.ndarray, begins: np.ndarray, least: float) -> Iterator[tuple[int, int]]:
    """The same for pairs (passage, block): bounds by all of the passage's terms, then the scores of the block's postings."""
    passage, block = np.divmod(pairs, index.n_blocks)
    sizes = begins[passage + 1] - begins[passage]
    pair = np.repeat(np.arange(len(pairs)), sizes)
    key = terms[_ranges(begins[passage], sizes)] * index.n_blocks + block[pair]
    place = np.minimum(np.searchsorted(index.block_key, key), len(index.block_key) - 1)
    hit = index.block_key[place] == key
    pair, place = pair[hit], place[hit]
    live = np.bincount(pair, index.block_bound[place], len(pairs)) >= least
    pair, place = pair[live[pair]], place[live[pair]]
    lists = index.block_postings[place + 1] - index.block_postings[place]
    post = _ranges(index.block_postings[place], lists)
    score = np.bincount(np.repeat(pair, lists) * BLOCK + index.segment[post] % BLOCK, index.impact[post], len(pairs) * BLOCK)
    for k in np.flatnonzero(score >= least).tolist():
        yield int(passage[k // BLOCK]), int(block[k // BLOCK]) * BLOCK + k % BLOCK


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for sizes[0] numbers, then the same for the next."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _grams(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + WORDS]) for i in range(max(1, len(words) - WORDS + 1))}


def verify(index: Index, flat: pa.Array, offsets: np.ndarray, found: set[tuple[int, int, int]], overlap: float) -> list[tuple[int, int, float, float | None]]:
    """(text, place of the item, share of the question's shingles, share of the answer's words or None) of what holds."""
    best: dict[tuple[int, int], tuple[float, float | None]] = {}
    for text, at, item in found:
        _, question, answer = index.items[item]
        reach = len(question) + len(answer)
        words = flat.slice(max(offsets[text], at - reach), min(offsets[text + 1], at + 2 * HALF + reach) - max(offsets[text], at - reach)).to_pylist()
        grams = _grams(question)
        if len(question) < WORDS:
            here = {tuple(words[i : i + len(question)]) for i in range(len(words) - len(question) + 1)}
        else:
            here = _grams(words)
        share = len(grams & here) / len(grams)
        told = len(set(answer) & set(words)) / len(set(answer)) if answer else None
        if share >= overlap and (told is None or told >= overlap):
            best[text, item] = max(best.get((text, item), (0.0, None)), (share, told), key=lambda x: x[0])
    return [(t, i, s, a) for (t, i), (s, a) in sorted(best.items())]


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, df) of a task's items, and of the empty term (segments, words in them)."""
    df, n, words = Counter(), 0, 0
    for batch in batches:
        flat, offsets = norm_words(batch.column(0))
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            for part in segments(flat.slice(a, b - a).to_pylist()):
                df.update(set(part))
                n, words = n + 1, words + len(part)
    yield pa.RecordBatch.from_pydict({"term": pa.array(["", *df]), "df": pa.array([n, *df.values()], pa.int64()), "words": pa.array([words] + [0] * len(df), pa.int64())})


def _indexes(items: DataFrame, answer: str | None) -> Iterator[Index]:
    """Indexes of about WORDS_AT_ONCE words of items each, of which the driver and the tasks hold one at a time."""
    columns = [F.col("item_id").cast("long").alias("item_id"), F.col("text"), F.col(answer).alias("answer") if answer else F.lit(None).cast("string").alias("answer")]
    frequencies = items.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_terms, "term string, df long, words long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("words").alias("words"))
    frequencies = written(frequencies, "decontaminate-terms")
    total = frequencies.filter("term = ''").first()
    if not total or not total["df"]:
        return
    turns = -(-total["words"] // WORDS_AT_ONCE)
    dealt = items.select(*columns).withColumn("turn", F.pmod(F.xxhash64("item_id", "text", "answer"), F.lit(turns)))
    for turn in range(turns):
        some = dealt.filter(F.col("turn") == turn)
        held = [(r[0], r[1] or "", r[2]) for r in some.drop("turn").orderBy("item_id", "text", "answer").toLocalIterator()]
        if turns == 1:
            df = {r["term"]: r["df"] for r in frequencies.toLocalIterator()}
        else:
            own = some.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_terms, "term string, df long, words long").select("term").distinct()
            df = {r["term"]: r["df"] for r in frequencies.join(own, "term", "left_semi").toLocalIterator()}
        yield build_index(held, total["df"], total["words"] / total["df"], df)


def matches(docs: DataFrame, items: DataFrame, text: str = "text", answer: str | None = None, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """For each row of docs and item that it holds: docs' other columns, item_id, question_overlap, answer_overlap."""
    clash = {"item_id", "question_overlap", "answer_overlap", text}
    kept = [c for c in docs.columns if c not in clash]
    source = docs.select(*kept, F.col(text).alias("__text"))
    added = [T.StructField("item_id", T.LongType()), T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType())]
    schema = T.StructType([*source.schema.fields[:-1], *added])
    out = docs.sparkSession.createDataFrame([], schema)
    for index in _indexes(items, answer):
        out = out.unionByName(source.mapInArrow(_matcher(docs.sparkSession.sparkContext.broadcast(index), threshold, overlap), schema))
    return out


def _matcher(shared, threshold: float, overlap: float):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for whole in batches:
            for batch in slices(whole, whole.num_columns - 1):
                flat, offsets = norm_words(batch.column(batch.num_columns - 1))
                rows = verify(index, flat, offsets, candidates(index, flat, offsets, threshold), overlap)
                if rows:
                    own = batch.take(pa.array([r[0] for r in rows]))
                    rows = [(r[0], index.items[r[1]][0], *r[2:]) for r in rows]
                    more = [pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.float64()))]
                    yield pa.RecordBatch.from_arrays([*own.columns[:-1], *more], [*batch.schema.names[:-1], "item_id", "question_overlap", "answer_overlap"])

    return match


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """docs without the rows that hold an item; each row is judged where it is, so no text is shuffled."""
    spark, out = docs.sparkSession, docs
    place = docs.columns.index(text)
    for index in _indexes(items, None):
        shared = spark.sparkContext.broadcast(index)

        @sparing
        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, place, FEW_BYTES):
                    flat, offsets = norm_words(batch.column(place))
                    rows = verify(shared.value, flat, offsets, candidates(shared.value, flat, offsets, threshold), overlap)
                    good = np.ones(batch.num_rows, bool)
                    good[[r[0] for r in rows]] = False
                    yield batch.filter(pa.array(good))

        out = out.mapInArrow(clean, docs.schema)
    return out


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it holds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
