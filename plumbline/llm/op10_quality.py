"""Quality rules: Jensen-Shannon distance of character classes and common words from references by language.

A language's references are the mean histograms of all documents said to be in it: one of character classes, one of
its commonest function words (and all other words as one more bin). A document goes when a distance is above its
bound and the document has enough words for the distance to mean something, or when it fails the base rules. The bound
of word distances is a fence above the quartiles of the language's own distances, so that it lies between the bulk and
the texts without common words.

Defined results: a null text is an empty one, which fails the base rules; a null or unknown language is compared with
the character classes of all such documents and has no word test; ties and repeated rows get equal verdicts; an empty
table gives an empty result; columns of the input are kept, and those added here replace any of the same name.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import forget, text_or_empty, words, written

#: The most frequent function words of each language that has a word test.
FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se"],
}
#: Character classes that are counted; other letters and the rest are told by subtraction, white space from the words.
RARE_CLASSES = {"upper": r"\p{Lu}", "digit": r"[0-9]", "punct": r"[.,;:!?'\"()\-]", "symbol": r"[#*$%&|<>]"}
#: Bins of word distances from 0 to 1.
BINS = 1_000
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rules:
    least_words: int = 20
    most_repeated: int = 30  # of 100 words
    window: int = 8
    class_bound: float = 0.33
    class_least_words: int = 25
    word_fence: float = 2.0  # interquartile ranges above the upper quartile
    word_bound: float = 0.44  # where a language has fewer than word_least_texts different distances
    word_least_texts: int = 20
    word_least_words: int = 50
    function_words: dict = field(default_factory=lambda: FUNCTION_WORDS)


def _removed(text: Column, pattern: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _one_of(values: list[str]):
    return lambda w: w.isin(values)


def _shift(array: Column, by: int, size: Column) -> Column:
    return F.slice(array, F.lit(by + 1), F.greatest(size - by, F.lit(0)))


def _head(array: Column, size: Column) -> Column:
    return F.slice(array, F.lit(1), F.greatest(size, F.lit(0)))


def with_histograms(df: DataFrame, rules: Rules) -> DataFrame:
    """df with _words, n_words, word_chars, n_symbols, and the histograms _classes and _common (array<long>)."""
    out = df.withColumn("_text", text_or_empty("text"))
    out = out.withColumn("_words", words(F.col("_text")))
    out = out.withColumn("n_words", F.size("_words").cast("long"))
    out = out.withColumn("_chars", F.char_length("_text").cast("long"))
    out = out.withColumn("word_chars", F.char_length(F.array_join("_words", "")).cast("long"))
    for name, pattern in RARE_CLASSES.items():
        out = out.withColumn(f"_{name}", _removed(F.col("_text"), pattern).cast("long"))
    rare = [F.col(f"_{name}") for name in RARE_CLASSES]
    lower = F.col("word_chars")
    for r in rare:
        lower = lower - r
    out = out.withColumn("n_symbols", F.col("_symbol"))
    out = out.withColumn("_classes", F.array(F.greatest(lower, F.lit(0).cast("long")), F.col("_chars") - F.col("word_chars"), *rare))
    # A word counts in lower case or with a capital; both forms are in the set that a word is looked up in.
    of_lang, bins = F.array().cast("array<string>"), F.array().cast("array<long>")
    for lang, common in rules.function_words.items():
        forms = sorted({*common, *(w.capitalize() for w in common)})
        of_lang = F.when(F.col("lang") == lang, F.transform(F.filter("_words", _one_of(forms)), lambda w: F.lower(w))).otherwise(of_lang)
    out = out.withColumn("_found", of_lang)
    for lang, common in rules.function_words.items():
        one = F.array(*(F.size(F.filter("_found", _one_of([c]))).cast("long") for c in common), F.col("n_words") - F.size("_found"))
        bins = F.when(F.col("lang") == lang, one).otherwise(bins)
    return out.withColumn("_common", bins)


def _widened(df: DataFrame, name: str, n: Column, width: int, step: int, where: Column | None) -> DataFrame:
    """Hashes of windows of width words become hashes of windows of width + step words (step <= width), null except where."""
    size, h = n - (width + step) + 1, F.col(name)
    both = F.zip_with(_head(h, size), _head(_shift(h, step, F.size(h)), size), lambda a, b: F.xxhash64(a, b))
    return df.withColumn(name, both if where is None else F.when(where, both))


def with_repeats(df: DataFrame, rules: Rules) -> DataFrame:
    """df (with _text, _words, n_words) with n_dup_lines and n_repeat_words.

    Windows of words are compared by 64-bit hashes, built from pairs, then pairs of pairs; the sorted hashes of a text
    show which windows occur twice, and the gaps between such windows how many words they cover.
    """
    w, n = rules.window, F.col("n_words").cast("int")
    out = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    out = out.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    out = out.withColumn("_h", F.transform("_words", lambda x: F.xxhash64(x)))
    width, half = 1, (w + 1) // 2
    while width < half:
        step = min(width, half - width)
        out, width = _widened(out, "_h", n, width, step, None), width + step
    # Most texts stop here: a window that comes twice makes at least so many half windows come twice.
    out = out.withColumn("_maybe", F.size("_h") - F.size(F.array_distinct("_h")) > w - half)
    while width < w:
        step = min(width, w - width)
        out, width = _widened(out, "_h", n, width, step, F.col("_maybe")), width + step
    out = out.withColumn("_again", F.coalesce(F.size(F.array_distinct("_h")) < F.size("_h"), F.lit(False)))
    at = F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    out = out.withColumn("_s", F.when(F.col("_again"), F.sort_array(at)))
    k = F.size("_s")
    out = out.withColumn("_hs", F.col("_s.h")).withColumn("_is", F.col("_s.i"))
    out = out.withColumn("_same", F.when(F.col("_again"), F.zip_with(_head(F.col("_hs"), k - 1), _shift(F.col("_hs"), 1, k), lambda a, b: a == b)))
    no = F.array(F.lit(False))
    twice = F.zip_with(F.concat(F.col("_same"), no), F.concat(no, F.col("_same")), lambda a, b: a | b)
    out = out.withColumn("_twice", twice)
    out = out.withColumn("_at", F.when(F.col("_again"), F.sort_array(F.filter(F.zip_with("_is", "_twice", lambda i, t: F.when(t, i)), lambda i: i.isNotNull()))))
    m = F.size("_at")
    gaps = F.zip_with(_head(F.col("_at"), m - 1), _shift(F.col("_at"), 1, m), lambda a, b: F.least(F.lit(w), b - a))
    covered = F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x) + w
    return out.withColumn("n_repeat_words", F.coalesce(F.when(F.col("_again"), covered), F.lit(0)).cast("long"))


def _known(rules: Rules) -> Column:
    return F.when(F.col("lang").isin(list(rules.function_words)), F.col("lang")).otherwise("")


def references(hist: DataFrame, rules: Rules) -> dict[str, tuple[list[float], list[float]]]:
    """For each known language, and "" for the others, the mean histograms; as many rows as languages come to the driver.

    hist has lang, n_words, _chars, _classes and _common of all documents, as with_histograms() gives them.
    """
    n_classes, n_common = 2 + len(RARE_CLASSES), 1 + max(map(len, rules.function_words.values()))
    share = lambda a, i, total: F.avg(F.coalesce(F.get(F.col(a), F.lit(i)), F.lit(0)) / F.col(total))
    rows = hist.filter(F.col("n_words") >= max(1, rules.least_words)).groupBy(_known(rules).alias("known")).agg(
        F.array(*(share("_classes", i, "_chars") for i in range(n_classes))).alias("classes"),
        F.array(*(share("_common", i, "n_words") for i in range(n_common))).alias("common"),
    )
    return {r["known"]: (r["classes"], r["common"]) for r in rows.collect()}


def _distance(counts: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance (base 2) of a histogram from a reference; 0 for an empty histogram."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    mass = sum(reference) or 1.0
    terms = []
    for i, r in enumerate(reference):
        p, q = F.coalesce(F.get(counts, F.lit(i)), F.lit(0)) / total, F.lit(r / mass)
        m = (p + q) / 2
        terms.append(F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0))
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return F.when(total > 0, F.sqrt(F.greatest(out / 2, F.lit(0.0)))).otherwise(0.0)


def _word_distance(refs: dict[str, tuple[list[float], list[float]]], rules: Rules) -> Column:
    out = F.lit(0.0)
    for lang, (_, common) in sorted(refs.items()):
        if lang:
            out = F.when(_known(rules) == lang, _distance(F.col("_common"), common)).otherwise(out)
    return out


def word_bounds(hist: DataFrame, refs: dict[str, tuple[list[float], list[float]]], rules: Rules) -> dict[str, float]:
    """For each known language, the bound of word distances; BINS rows a language at most come to the driver.

    hist is as for references(). Copies have one distance and count once.
    """
    each = hist.filter((F.col("n_words") >= rules.word_least_words) & (_known(rules) != "")).select(_known(rules).alias("known"), F.round(_word_distance(refs, rules), 6).alias("d")).distinct()
    rows = each.groupBy("known", F.floor(F.col("d") * BINS).alias("bin")).count().collect()
    out = {}
    for lang in rules.function_words:
        bins = sorted((r["bin"], r["count"]) for r in rows if r["known"] == lang)
        at, n = [b for b, _ in bins], list(accumulate(c for _, c in bins))
        if n and n[-1] >= rules.word_least_texts:
            low, high = ((at[bisect_left(n, n[-1] * part / 4)] + 0.5) / BINS for part in (1, 3))
            out[lang] = high + rules.word_fence * (high - low)
        else:
            out[lang] = rules.word_bound
    return out


#: What a verdict needs of a text.
FEATURES = [*BASE, "_chars", "_classes", "_common"]


def features(df: DataFrame, rules: Rules) -> DataFrame:
    """df (text, lang) with FEATURES, all from one pass over the text."""
    kept = [c for c in df.columns if c not in {*FEATURES, *VERDICT}]
    return with_repeats(with_histograms(df.select(*kept), rules), rules).select(*kept, *FEATURES)


VERDICT = ["class_distance", "word_distance", "base_failed", "kept"]


def verdict(df: DataFrame, refs: dict[str, tuple[list[float], list[float]]], bounds: dict[str, float], rules: Rules) -> DataFrame:
    """df with FEATURES and lang becomes df with BASE and VERDICT; bounds are those of word distances."""
    class_d = F.lit(0.0)
    for lang, (classes, _) in sorted(refs.items()):
        class_d = F.when(_known(rules) == lang, _distance(F.col("_classes"), classes)).otherwise(class_d)
    bound = F.lit(rules.word_bound)
    for lang, value in sorted(bounds.items()):
        bound = F.when(_known(rules) == lang, value).otherwise(bound)
    failed = (F.col("n_words") < rules.least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.most_repeated)
    far = ((F.col("class_distance") > rules.class_bound) & (F.col("n_words") >= rules.class_least_words)) | ((F.col("word_distance") > bound) & (F.col("n_words") >= rules.word_least_words))
    out = df.withColumns({"class_distance": class_d, "word_distance": _word_distance(refs, rules), "base_failed": failed})
    return out.withColumn("kept", ~F.col("base_failed") & ~far).drop("_chars", "_classes", "_common")


def judge(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """df without text, with the base counts, the two distances, base_failed and kept: one pass over the texts."""
    small = written(features(df, rules).drop("text"), "quality")
    refs = references(small, rules)
    return verdict(small, refs, word_bounds(small, refs, rules), rules)


def keep_good(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of df that the rules keep, with their texts and columns unchanged.

    A first pass gathers the references and bounds; a second one judges each text where it is, so that no text is shuffled.
    """
    hist = written(with_histograms(df.select("text", "lang"), rules).select("lang", "n_words", "_chars", "_classes", "_common"), "quality-histograms")
    refs = references(hist, rules)
    bounds = word_bounds(hist, refs, rules)
    forget(hist)
    marked = verdict(features(df.withColumn("_row", F.struct(*df.columns)), rules), refs, bounds, rules)
    # A column that isn't deterministic keeps the filter above the verdict: pushed below, it would repeat all of it.
    marked = marked.withColumn("_place", F.monotonically_increasing_id())
    return marked.filter(F.col("kept") & (F.col("_place") >= 0)).select("_row.*")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return judge(docs).drop("lang")
