"""HTML extraction by maximum-scoring subsequences.

A page is a sequence of text blocks and tags. Words score above 0 and tags below, with weights from all pages whose
article is marked (log odds of lying inside it); one linear scan finds the contiguous runs that can't be made better by
any change of their ends (Ruzzo and Tompa), and the best of them, with those that score at least RUN_SHARE of it, is the
text. On a page with a marked article the mark is a feature too: words outside it score below 0, and tags inside it 0.
Elements that never hold an article's text (scripts, menus, forms, adverts, comments and the like, by element name or by
class, id and role) take no part in the scan and give no text, unless nothing else on the page has any.

Defined results: a null or empty page has the text ""; markup that is cut off is read as far as it goes; ties between
runs keep all of them; repeated rows are extracted each; an empty table gives an empty result; columns of the input
are kept, and those added here replace any of the same name.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import text_or_empty

#: Share of the best run's score from which another run is taken too.
RUN_SHARE = 0.25
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<", re.S)
_RAW = {n: re.compile(rf"</{n}\b[^>]*(?:>|\Z)|\Z", re.I) for n in ("script", "style", "title", "textarea", "noscript", "iframe", "template", "svg")}
_NO_TEXT = {*_RAW, "head", "nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "object", "canvas", "audio", "video"}
_BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_OUTSIDE = r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|comments?|disqus|replies|respond|cookies?|consent|notices?|alert|popup|modal|newsletter|subscribe|sidebar|side|widget|related|recommend\w*|share|sharing|social|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|legal|copyright)"
_OUTSIDE_WORD = re.compile(_OUTSIDE, re.I)
#: Of a class of several words every one must be such a word or say nothing; and none of an element's may speak of content.
_NEUTRAL = re.compile(r"(?:site|page|web|global|main|top|bottom|left|right|primary|secondary|list|items?|box|wrap\w*|container|area|bar|block|section|inner|outer|links?|posts?|articles?|stories|form|title|buttons?|icons?|group|row|col\w*|sticky|fixed|\w|\d+)", re.I)
_CONTENT = re.compile(r"(?:content|main|article|story|entry|post|body)(?=$|[\s_-])", re.I)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)


def _is_hidden(named: dict[str, str]) -> bool:
    return named.get("hidden", "false").lower() != "false" or named.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(named.get("style", "")))


def _is_outside(name: str, attributes: str, inside_article: bool) -> bool:
    if name in _NO_TEXT:
        return not (name == "header" and inside_article)
    if name in ("html", "body", "article", "main") or not attributes:
        return False
    named: dict[str, str] = {}
    for key, *values in _ATTRIBUTE.findall(attributes):
        named.setdefault(key.lower(), "".join(values))
    if _is_hidden(named):
        return True
    if inside_article:
        return any(_OUTSIDE_WORD.fullmatch(w) for k in ("class", "id", "role") for w in named.get(k, "").split())
    names = [w for k in ("class", "id", "role") for w in named.get(k, "").split()]
    if any(_CONTENT.match(part) for w in names for part in re.split("[_-]", w)) and not any(_OUTSIDE_WORD.fullmatch(w) for w in names):
        return False
    return any(_is_outside_name(w) for w in names) or bool(_OUTSIDE_WORD.fullmatch(named.get("aria-label", "")))


def _is_outside_name(name: str) -> bool:
    parts = [x for x in re.split("[_-]+", name) if x]
    return any(_OUTSIDE_WORD.fullmatch(x) for x in parts) and all(_OUTSIDE_WORD.fullmatch(x) or _NEUTRAL.fullmatch(x) for x in parts)


def parse(page: str, by_name: bool = True) -> list[tuple[str, str, bool]]:
    """(tag name or "", text of a block, inside an article element) in page order; by_name: without elements outside by class."""
    out: list[tuple[str, str, bool]] = []
    block: list[str] = []
    articles, skip, depth, at, end = 0, "", 0, 0, len(page)

    def flush() -> None:
        text = " ".join(html.unescape("".join(block)).split()) if block else ""
        block.clear()
        if text:
            out.append(("", text, articles > 0))

    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            if not skip and m[0][:2] not in ("<!", "<?"):
                block.append(m[0])
            continue
        name, closing = name.lower(), bool(m[1])
        if skip:
            if name == skip:
                depth += -1 if closing else not m[3].endswith("/")
            elif (skip in ("p", "li") and name in _BLOCK) or (skip == "head" and name == "body"):
                depth = 0
            if depth > 0:
                continue
            ended_by_other, skip = name != skip, ""
            if not ended_by_other:
                continue
        if name in _BLOCK:
            flush()
        elif name == "br":
            block.append(" ")
        if name == "article":
            articles = max(0, articles + (-1 if closing else 1))
        if not closing and name in _RAW:
            at = _RAW[name].search(page, at).end()
            continue
        if not closing and name not in _VOID and (name in _NO_TEXT or by_name) and _is_outside(name, m[3], articles > 0):
            flush()
            skip, depth = name, 1
            continue
        if name in _BLOCK or name == "a":
            # Tags within a run of text weigh on it, but don't end it; they are told apart from the text by order only.
            out.append((name, "", articles > 0))
    flush()
    return out


def _counted(page: str) -> Counter:
    """(tag or "" for words, inside the article): how many of a page whose article is marked."""
    parsed, out = parse(page), Counter()
    if any(inside for _, _, inside in parsed):
        for tag, text, inside in parsed:
            out[tag, inside] += 1 if tag else text.count(" ") + 1
    return out


def fit_weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Weights from the counts of marked pages: "" for a word, above 0; a tag's name for a tag, below 0."""
    tags = {t for t, _ in counts if t}
    n_in, n_out = (sum(n for (_, i), n in counts.items() if i == inside) + len(tags) + 1 for inside in (True, False))
    if not any(inside for _, inside in counts):
        return {"": 1.0}
    odds = {t: math.log((counts.get((t, True), 0) + 1) / n_in) - math.log((counts.get((t, False), 0) + 1) / n_out) for t in ("", *tags)}
    return {t: min(2.0, max(0.5, odds[t])) if not t else -min(6.0, max(0.01, -odds[t])) for t in odds}


def runs(scores: list[float]) -> list[tuple[int, int, float]]:
    """Start, end and score of every maximal run, in one pass (amortised): each is better than any run it is part of."""
    out: list[list] = []  # start, end, sum before, sum up to the end
    total = 0.0
    for i, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        run = [i, i + 1, before, total]
        while True:
            at = len(out) - 1
            while at >= 0 and out[at][2] >= run[2]:
                at = out[at][4] - 1
            if at < 0 or out[at][3] >= run[3]:
                break
            run[0], run[2] = out[at][0], out[at][2]
            del out[at:]
        out.append([*run, at + 1])  # the last: where the next run before it with a lesser sum ends
    return [(a, b, after - before) for a, b, before, after, _ in out]


def extract(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    parsed = parse(page)
    if not any(not tag for tag, _, _ in parsed):
        parsed = parse(page, by_name=False)
    marked, word = any(inside and not tag for tag, _, inside in parsed), weights.get("", 1.0)

    def score(tag: str, text: str, inside: bool) -> float:
        if marked and tag:
            return 0.0 if inside else weights.get(tag, -0.5)
        return weights.get(tag, -0.5) if tag else (word if inside or not marked else -word) * (text.count(" ") + 1)

    found = runs([score(*x) for x in parsed])
    least = RUN_SHARE * max((x[2] for x in found), default=0.0)
    texts = [x for start, stop, total in found if total >= least for x in parsed[start:stop]]
    return "\n".join(text for tag, text, inside in texts if not tag and (inside or not marked))


def learn(pages: DataFrame, column: str = "html") -> dict[str, float]:
    """Weights from all pages with a marked article; one row a tag name comes to the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                counts.update(_counted(page))
        # Names that aren't HTML's are the authors' own; they share one weight.
        rows = Counter()
        for (tag, inside), n in counts.items():
            rows[tag if tag in _BLOCK or tag in ("", "a") else "?", inside] += n
        yield pa.RecordBatch.from_pydict({"tag": pa.array([t for t, _ in rows], pa.string()), "inside": pa.array([i for _, i in rows], pa.bool_()), "n": pa.array(list(rows.values()), pa.int64())})

    marked = pages.select(F.col(column).alias("h")).filter(F.col("h").rlike("(?i)<article\\b"))
    found = marked.mapInArrow(counted, "tag string, inside boolean, n long").groupBy("tag", "inside").agg(F.sum("n").alias("n"))
    return fit_weights({(r["tag"], r["inside"]): r["n"] for r in found.collect()})


def extract_text(pages: DataFrame, weights: dict[str, float], column: str = "html") -> DataFrame:
    """pages with text and n_chars."""
    kept = [c for c in pages.columns if c not in ("text", "n_chars") and c != column]
    source = pages.select(*kept, text_or_empty(column).alias("__html"))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x, weights) for x in batch.column(batch.num_columns - 1).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), sizes], [*batch.schema.names[:-1], "text", "n_chars"])

    schema = T.StructType([*source.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return source.mapInArrow(extracted, schema)


def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages, learn(pages))
