"""The operators against brute force on a small table with nulls, empty and long texts, copies, ties and clashing names."""

import base64
import collections
import hashlib
import io
import math
import random
import re
import zipfile
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def make_texts() -> list:
    rng = random.Random(3)
    vocabulary = ["the", "of", "and", "to", "in", "Éa", "naïve"] + ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = prose(120)
    out = [None, "", " ", "\n\n", "one", "a b c d", base, base, base.upper()]
    for i in range(12):
        w = base.split()
        for _ in range(i // 3):
            w[rng.randrange(len(w))] = prose(1)
        out.append(" ".join(w))
    line = prose(14)
    out += [line + "\n" + prose(rng.randint(5, 60)) for _ in range(12)]
    out += [prose(40) + "\n" + " ".join([prose(9)] * 6), prose(6000), "<|endoftext|> x  y <|endoftext|>", "tab\there  two 　 wide", "same line\n\nsame line\nsame line", "### &&& %%% $$$ " * 20]
    return out + [prose(rng.randint(1, 90)) for _ in range(20)]


@pytest.fixture(scope="module")
def texts():
    return make_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", "de", None, "xx"][i % 4], [None, "a", "b", "b", "é"][i % 5], i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long").repartition(3).cache()


@pytest.fixture(scope="module")
def sf(spark, docs, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, " ".join(docs.filter("doc_id = 6").first()["text"].split()[20:60])), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


@pytest.fixture(scope="module")
def empty_sf(spark, docs, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("empty"))
    docs.limit(0).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{at}/pages.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{at}/conversations.parquet")
    return at


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = words(lower(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_empty_tables(spark, empty_sf):
    from plumbline.llm.queries import QUERIES

    for name, query in QUERIES.items():
        rows = query(spark, empty_sf).collect()
        assert [r["conv_id"] for r in rows] == [-7] if name == "op7_chat" else rows == [], name


def test_tokens(spark, sf, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    from plumbline.llm.op01_tokens import op1_tokens

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: r for r in op1_tokens(spark, sf).collect()}
    for i, x in enumerate(texts):
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((x or "").encode()), n > 1024)


def test_extract(spark):
    from plumbline.llm.op02_extract import extract, extract_text, learn

    pages = [
        (1, "u", '<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><a href="/x">m</a></nav><div class="ad">buy it now</div><article><h1>Head &amp; tail</h1><p>One  two\n three<p>Four<div class="ad">no</div><p>Five<script>x()</script></article><section id="comments"><p>first!</p></section><footer>f f</footer></body></html>'),
        (2, None, None), (3, "u", ""), (4, "u", "<article><h1>Cut &am"), (4, "u", "<article><h1>Cut &am"),
    ]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, text string")
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in extract_text(df, learn(df)).collect()]
    first = "Head & tail\nOne two three\nFour\nFive"
    assert sorted(got) == sorted([(1, first, len(first)), (2, "", 0), (3, "", 0), (4, "Cut &am", 7), (4, "Cut &am", 7)])
    long = "<article>" + "<p>word word</p>" * 20_000 + "</article>"
    assert extract(long, {"": 1.0, "p": -0.01}).count("\n") == 19_999


def test_extract_drops_only_hidden_and_outside_elements():
    from plumbline.llm.op02_extract import extract

    weights = {"": 1.0}
    for kept in ('class="overflow-hidden"', 'style="overflow:hidden"', 'hidden="false"', 'class="side-note"', 'class="legal-history"'):
        assert extract(f"<article><div {kept}><p>one two</p></div></article>", weights) == "one two", kept
    for gone in ("hidden", 'hidden=""', 'aria-hidden="true"', 'style="color:red; display: none"', "style='visibility:hidden'", 'class="x share"'):
        assert extract(f"<article><p>one two</p><div {gone}><p>three</p></div></article>", weights) == "one two", gone
    for kept in ('style="overflow:hidden"', 'class="post hidden-print"', 'class="share-price-report"', 'class="col side-content main-column"', 'class="sidebar"'):
        assert extract(f"<body><div {kept}><p>one two</p><p>three four</p></div></body>", {"": 1.0, "p": -0.1, "div": -0.5}) == "one two\nthree four", kept
    for gone in ('class="site-footer"', 'id="cookie-notice"', 'class="ad-banner top"', 'role="navigation"', 'class="comment-list"', 'class="related_posts"'):
        assert extract(f"<body><div><p>one two three four five</p></div><div {gone}><p>six</p></div></body>", {"": 1.0, "p": -0.1, "div": -0.1}) == "one two three four five", gone


def test_maximal_runs():
    """Against all runs: a maximal one is better than every run inside it that it isn't, and no other touches it."""
    from plumbline.llm.op02_extract import runs

    rng = random.Random(4)
    for _ in range(300):
        scores = [rng.choice([-3, -2, -1, 1, 2, 3]) for _ in range(rng.randint(0, 14))]

        def maximal(a, b):
            if a == b:
                return []
            best, _, start, stop = max(((sum(scores[i:j]), j - i, -i, j) for i in range(a, b) for j in range(i + 1, b + 1)), key=lambda x: (x[0], -x[1], x[2]))
            return [] if best <= 0 else maximal(a, -start) + [(-start, stop, best)] + maximal(stop, b)

        assert sum(x[2] for x in runs(scores)) == sum(x[2] for x in maximal(0, len(scores))), scores


def test_extract_query(spark, tmp_path):
    """The query against what made the pages: articles with lists of links, inline markup and references, and all around them."""
    import html

    from plumbline.llm.op02_extract import op2_extract

    rng = random.Random(8)
    prose = lambda n: " ".join(rng.choice(["one", "two", "a&b", "<x>", "Éa", "three", "four"]) for _ in range(n))
    rows, expected = [], {}
    for i in range(60):
        blocks, body = [], []
        for _ in range(rng.randint(1, 6)):
            text = prose(rng.randint(1, 60))
            blocks.append(text)
            half = html.escape(text).split(" ")
            body.append(rng.choice(["<p>%s</p>", "<h2>%s</h2>", "<div class='text-body'><p>%s</div>", "<p><b>%s</b></p>\n"]) % "  \n".join(half))
            if rng.random() < 0.4:
                links = [prose(1) for _ in range(30)]
                blocks += links
                body.append("<ul>" + "".join(f'<li><a href="/x">{html.escape(x)}</a></li>' for x in links) + "</ul>")
            if rng.random() < 0.3:
                body.append(rng.choice(['<aside>%s</aside>', '<form><p>%s</p></form>', '<div class="ad">%s</div>', "<script>%s</script>", "<!-- %s -->"]) % "buy this now")
        around = '<nav><ul><li><a href="/">home</a></li></ul></nav><header><h1>Site</h1></header><div class="cookie-notice"><p>We use them</p></div>'
        after = '<section class="comments"><article><p>First! great work indeed</p></article></section><footer><p>&copy; all of it reserved</p></footer>'
        page = f"<html><head><title>t</title><style>p{{}}</style></head><body>{around}<article>{''.join(body)}</article>{after}</body></html>"
        rows.append((i, "u", page))
        expected[i] = "\n".join(blocks)
    rows += [(60, "u", None), (61, None, "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r for r in op2_extract(spark, str(tmp_path)).collect()}
    assert {i: r["text"] for i, r in got.items()} == expected | {60: "", 61: ""}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_sharding(spark, sf, texts):
    from plumbline.llm.op03_sharding import op3_sharding, shard

    got = op3_sharding(spark, sf).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in enumerate(texts)]
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    hot = spark.range(4000).select("id", F.lit(7).cast("long").alias("h"), F.lit(None).cast("string").alias("shard"))
    sizes = [r["n"] for r in shard(hot, 8, F.lit(10), F.col("h"), F.col("id")).groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 8
    rows = spark.range(4000).select(F.when(F.col("id") < 2000, 5).when(F.col("id") < 3000, F.lit(None)).otherwise(F.col("id")).cast("long").alias("id"))
    got = shard(rows, 8, F.lit(10), F.lit(7), F.col("id")).collect()
    sizes = collections.Counter(r["shard"] for r in got)
    assert len(got) == 4000 and len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 12
    assert all(sorted(r["slot"] for r in got if r["shard"] == k) == list(range(n)) for k, n in sizes.items())


def test_write_shards(spark, sf, texts, tmp_path):
    from plumbline.llm.op03_sharding import shard, write_shards

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    write_shards(shard(docs, 3, F.octet_length("text"), F.lit(0), F.col("doc_id")), f"{tmp_path}/shards")
    assert sorted(p.name for p in (tmp_path / "shards").glob("shard=*")) == ["shard=0", "shard=1", "shard=2"]
    assert sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/shards").collect()) == list(enumerate(texts))


def lm_tokens(text):
    return [*words(lower(text)), None]


class PlainScorer:
    """The model's log probabilities, token by token and bit by bit, in plain Python."""

    def __init__(self, model):
        from plumbline.llm import op04_lm as m
        from plumbline.llm.shingles import word_hashes

        self.m, self.model, self.book = m, model, model.book
        self.of = lambda w: int(word_hashes(pa.array([w]))[0])
        self.leaf = {int(h): i for i, h in enumerate(model.book.hashes)}

    def bit(self, mixer, slots, one):
        v = [int(self.model.table[s]) for s in slots]
        gate = (v[-2] & 3) * 4 + (v[-1] & 3)
        dot = sum(float(mixer.weights[k, gate]) * (x >> 2) for k, x in enumerate(v)) / 256
        x = min(11.99, max(-11.99, dot)) * 2 + self.m.BUCKETS // 2
        low = int(x)
        p = float(mixer.map_[gate, low]) * (1 - x + low) + float(mixer.map_[gate, low + 1]) * (x - low)
        return math.log(p if one else 1 - p)

    def spelled(self, data):
        """data: bytes with the space at the end."""
        from plumbline.llm.shingles import mixed

        np, m, total, prefix, gold = self.m.np, self.m, 0.0, 0, 0x9E3779B97F4A7C15
        mix = lambda x: int(mixed(np.array([x & (1 << 64) - 1], np.uint64))[0])
        for i, byte in enumerate(data):
            contexts = []
            for back in range(3, 5):
                before = sum(data[i - k] << 8 * (k - 1) for k in range(1, back + 1) if i >= k)
                contexts.append(mix(before + (back << 40)) >> 32)
            contexts.append(prefix >> 32)
            for bit in range(8):
                node = ((byte | 256) >> (8 - bit)) * 0x9E3779B1 & 0xFFFFFFFF
                slots = [(((c ^ node) * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - b)) + int(at) + m.WORD_SLOTS for c, b, at in zip(contexts, m.BYTE_BITS, m._BYTE_AT, strict=False)]
                total += self.bit(self.model.bytes, slots, byte >> (7 - bit) & 1)
            prefix = mix(prefix * gold + byte + 1)
        return total

    def path(self, leaf, klass, last, both):
        book, total, node, root = self.book, 0.0, leaf, len(self.book.up) - 1
        while node != root:
            side, node = int(book.up[node]) & 1, int(book.up[node]) >> 1
            inner = node - len(book.hashes) - 2
            spread = inner * 0x9E3779B1 & 0xFFFFFFFF
            slots = [klass * (self.m.CODED + 2) + inner] + [(((c ^ spread) * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - b)) + int(at) for c, b, at in zip((last, both), self.m.WORD_BITS, self.m._WORD_AT, strict=False)]
            total += self.bit(self.model.words, slots, side)
        return total

    def state(self, before):
        """(class, last, both) after some tokens."""
        book, klass = self.book, 0
        if len(book.evidence):
            told = book.prior + sum((book.evidence[:, self.leaf.get(self.of(w), book.escape)].astype(float) for w in before), 0.0 * book.prior)
            klass = int(told.argmax()) + 1
        short = [self.of(w) >> 32 for w in before[-2:]]
        last, two = short[-1] if short else 0, short[-2] if len(short) > 1 else 0
        return klass, last, (last * 0xC2B2AE35 & 0xFFFFFFFF) ^ ((two * 0x27D4EB2F & 0xFFFFFFFF) >> 3) ^ 0x5BD1E995

    def token(self, before, word):
        book = self.book
        leaf = book.end if word is None else self.leaf.get(self.of(word), book.escape)
        p = math.exp(self.path(leaf, *self.state(before)) + (self.spelled(word.encode() + b" ") if leaf == book.escape else 0))
        n = len(before)
        share = float(self.model.share[min(self.m.AGES - 1, int(math.log2(2 * n)))]) if n else 0.0
        return math.log((1 - share) * p + (share * before.count(word) / n if n and word is not None else 0))


def test_lm(spark, sf, texts, monkeypatch):
    """Counts and base scores by brute force; scores by the plain scorer; held-out texts do better than by the base."""
    from plumbline.llm import op04_lm as m

    models, learn = [], m.learn
    monkeypatch.setattr(m, "learn", lambda *a: models.append(learn(*a)) or models[-1])
    got = {r["doc_id"]: r for r in m.op4_lm(spark, sf).collect()}
    tokens = {i: lm_tokens(t) for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = collections.Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    plain, compared = PlainScorer(models[0][3]), 0
    for i, t in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        if len(t) < 150:
            expected = sum(plain.token(t[:k], w) for k, w in enumerate(t)) / math.log(10)
            assert math.isclose(r["score"], expected, rel_tol=1e-3), i
            size = len((texts[i] or "").encode())
            assert r["bits_per_byte"] is None if not size else math.isclose(r["bits_per_byte"], -r["score"] * math.log2(10) / size)
            compared += 1
    assert compared > 40 and {held[i] for i in tokens} == {True, False}
    assert sum(got[i]["score"] for i in tokens if held[i]) > sum(got[i]["base_score"] for i in tokens if held[i])


def test_lm_probabilities_sum_to_one(spark, sf):
    """After any words: all coded words, the end and the escape; after the escape: all bytes that may follow some others."""
    from plumbline.llm import op04_lm as m

    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.coalesce("text", F.lit("")).alias("text"), F.lit(0).alias("class"))
    plain = PlainScorer(m.learn(docs, [docs.count()])[3])
    book = plain.book
    for before in ([], ["the"], ["zzz", "of"], ["of", "the", "of"]):
        state = plain.state(before)
        assert len(book.hashes) > 100 and math.isclose(sum(math.exp(plain.path(leaf, *state)) for leaf in range(len(book.hashes) + 2)), 1, rel_tol=1e-6)
    for start in (b"", b"ab", "É".encode()):
        assert math.isclose(sum(math.exp(plain.spelled(start + bytes([k])) - plain.spelled(start)) for k in range(256)), 1, rel_tol=1e-6)


MEMORY = """
import re, sys, threading, time
import numpy as np, pyarrow as pa
from plumbline.llm import op09_jaccard as m

def now():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

class Shared:
    value = np.zeros(0, np.uint64)

def run(n):
    rng = np.random.default_rng(3)
    texts = pa.array([" ".join(map(str, rng.integers(0, 10**7, 300).tolist())) for _ in range(n)])
    ids = pa.array(np.arange(n))
    batch, most, over, base = pa.RecordBatch.from_arrays([ids, texts, ids], ["doc_id", "text", "tag"]), [0], [], now()
    def watch():
        while not over:
            most[0] = max(most[0], now())
            time.sleep(0.005)
    thread = threading.Thread(target=watch)
    thread.start()
    rows = sum(b.num_rows for b in m._features(Shared)(iter([batch])))
    over.append(1)
    thread.join()
    return rows, most[0] - base, now() - base

run(100)
print(*run(8000))
"""


def test_tasks_give_memory_back():
    """A task over 19 MB of texts needs little beside them, and leaves almost nothing in its worker."""
    import subprocess
    import sys
    from pathlib import Path

    rows, most, left = map(float, subprocess.run([sys.executable, "-c", MEMORY], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2]).stdout.split())
    assert rows == 8000 and most < 90 and left < 25, (most, left)


def test_driver_gives_memory_back(spark):
    from pathlib import Path

    from plumbline.llm.common import written

    jvm = spark._jvm
    rollup = Path(f"/proc/{jvm.java.lang.ProcessHandle.current().pid()}/smaps_rollup")
    anonymous = lambda: int(re.search(r"Pss_Anon:\s+(\d+)", rollup.read_text())[1]) / 1024
    for _ in range(3):
        written(spark.range(9), "warm")
    # Memory of malloc's in the JVM; what comes last keeps the rest from being given back by itself.
    field = jvm.java.lang.Class.forName("sun.misc.Unsafe").getDeclaredField("theUnsafe")
    field.setAccessible(True)
    unsafe, size = field.get(None), 100_000
    made = [unsafe.allocateMemory(size) for _ in range(2_000)]
    for x in made:
        unsafe.setMemory(x, size, 1)
    for x in made[:-1]:
        unsafe.freeMemory(x)
    before = anonymous()
    assert written(spark.range(9), "trimmed").count() == 9
    assert before - anonymous() > 100
    unsafe.freeMemory(made[-1])


def test_lm_learns_from_all(spark, sf, texts, monkeypatch):
    """Weights, maps and the cache's share are learned from every bit and token of all texts and spelled words."""
    from plumbline.llm import op04_lm as m

    sums, mixer = [], m._mixer
    monkeypatch.setattr(m, "_mixer", lambda *a: sums.append(a) or mixer(*a))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.coalesce("text", F.lit("")).alias("text"), F.lit(0).alias("class"))
    plain = PlainScorer(m.learn(docs, [docs.count()])[3])
    book, tokens = plain.book, [lm_tokens(t) for t in texts]
    coded = lambda w: plain.leaf.get(plain.of(w), book.escape) if w is not None else book.end
    path_bits = sum(int(book.depth[coded(w)]) for t in tokens for w in t)
    spelled = {w for t in tokens for w in t if w is not None and coded(w) == book.escape}
    byte_bits = sum(8 * (len(w.encode()) + 1) for w in spelled)
    assert path_bits > 10_000 and byte_bits > 300
    for (state, contexts), bits in zip(sums, (path_bits, byte_bits), strict=True):
        _, seen, hits, total, more = m.np.split(state, m.np.cumsum([m.GATES * contexts, m.GATES, m.GATES * m.BUCKETS, m.GATES * m.BUCKETS]))
        assert seen.sum() == bits and math.isclose(total.sum(), bits, rel_tol=1e-6) and 0 < hits.sum() < bits
        if len(more):
            assert more[m.AGES :].sum() == sum(len(t) - 1 for t in tokens)


def test_lm_learner_by_hand():
    """A bit is predicted from what was counted before it; the counts and the map's shares are those of plain loops."""
    from plumbline.llm import op04_lm as m

    np, rng, steps = m.np, m.np.random.default_rng(5), 70
    learner, counts = m.Learner(m.BLOCK, 3), np.zeros((m.BLOCK, 2), int)
    weights, squares = np.full((m.GATES, 3), 0.4), np.full((m.GATES, 3), 1e-2)
    hits, total = np.zeros((m.GATES, m.BUCKETS)), np.zeros((m.GATES, m.BUCKETS))
    for _ in range(steps):
        slots, ones = [rng.integers(0, n, 20) for n in (3, 40, 400)], rng.integers(0, 4, 20) // 3
        got, gates, sts = learner.learn(slots, ones), [], []
        for i, one in enumerate(ones.tolist()):
            cells = [counts[s[i]] for s in slots]
            st = np.array([math.log((o + 0.4) / (z + 0.4)) for z, o in cells])
            step = [sum(int(z + o) >= x for x in (1, 4, 32)) for z, o in cells]
            gates.append(step[1] * 4 + step[2])
            sts.append(st)
            dot = float(weights[gates[-1]] @ st)
            p = 1 / (1 + math.exp(-dot))
            assert math.isclose(got[i], math.log(p if one else 1 - p), rel_tol=1e-2, abs_tol=1e-3)
            x = dot * 2 + m.BUCKETS // 2
            for b, share in ((int(x), 1 - x + int(x)), (int(x) + 1, x - int(x))):
                total[gates[-1], b] += share
                hits[gates[-1], b] += share * one
        error = ones - np.array([1 / (1 + math.exp(-float(weights[g] @ st))) for g, st in zip(gates, sts, strict=True)])
        step = np.zeros((m.GATES, 3))
        np.add.at(step, gates, error[:, None] * np.array(sts))
        squares += step * step
        weights += 0.1 * step / np.sqrt(squares)
        for s in slots:
            np.add.at(counts, (s, ones), 1)
    assert (learner.counts == counts).all() and learner.counted == 20 * steps
    state = np.frombuffer(learner.state(0, np.zeros(0)).column(1)[0].as_py())
    w, seen, h, t = np.split(state, np.cumsum([m.GATES * 3, m.GATES, m.GATES * m.BUCKETS]))
    assert seen.sum() == 20 * steps and (seen == total.sum(1).round(6)).all()
    assert np.allclose(w.reshape(m.GATES, 3), weights * seen[:, None], rtol=1e-2, atol=1e-2)
    assert np.allclose(h, hits.ravel(), rtol=1e-2, atol=0.05) and np.allclose(t, total.ravel(), rtol=1e-2, atol=0.05)
    (block,) = learner.blocks(0)
    assert (np.stack([np.frombuffer(block.column(k)[0].as_py(), np.uint16) for k in (1, 2)], 1) == counts).all() and not learner.counts.any()


def test_lm_slow_logarithms_are_few(monkeypatch):
    """np.log1p has no vector code for single precision: neither bits nor tokens go through it one by one."""
    from plumbline.llm import op04_lm as m

    np, seen, log1p = m.np, [0], m.np.log1p
    book = m.Codebook.of(np.sort(m.word_hashes(pa.array(["a", "b", "c"]))), np.array([9, 5, 3]), np.zeros((3, 0)), 2, 4, np.zeros(0))
    tokens = m.Tokens.of(pa.array([" ".join("abcdx"[k % 5] for k in range(2_000))]), book)
    monkeypatch.setattr(np, "log1p", lambda x, *a, **b: seen.__setitem__(0, seen[0] + np.size(x)) or log1p(x, *a, **b))
    learner = m.Learner(m.WORD_SLOTS, 3)
    for ones, slots in book.paths(tokens, slice(0, 2_001))[1]:
        learner.learn(slots, ones)
    mixer, _ = m._mixer(None, 3)
    model = m.Model(book, np.zeros(m.WORD_SLOTS + m.BYTE_SLOTS, np.int16), mixer, mixer, np.full(m.AGES, 0.1))
    first = model.score(tokens, np.zeros(len(tokens.words)))
    assert learner.counted > 4_000 and seen[0] <= 2 * m.AGES
    # Scores don't depend on how many tokens are scored together.
    monkeypatch.setattr(m, "SCORED", 300)
    assert np.allclose(first, model.score(tokens, np.zeros(len(tokens.words))), rtol=1e-12)


def test_lm_products_of_long_paths():
    from plumbline.llm import op04_lm as m

    levels = [(n, m.np.full(n, 1e-6, m.np.float32)) for n in range(1, 91)]
    assert m.np.allclose(m._log_product(90, iter(levels)), [math.log(1e-6) * (90 - k) for k in range(90)], rtol=1e-6)


def test_mixing(spark, sf, texts):
    from plumbline.llm.op05_mixing import mix, op5_mixing

    got = op5_mixing(spark, sf).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got) == [(i, len(words(t))) for i, t in enumerate(texts)]
    by = collections.defaultdict(list)
    for r in got:
        assert r["taken"] <= 2 * r["size"]
        by[r["source_size"], r["target"]].append(r)
    assert math.isclose(sum(t for _, t in by), 1.5 * sum(s for s, _ in by))
    for (s, t), rows in by.items():
        assert sum(r["size"] for r in rows) == s and t <= 2 * s
        assert abs(sum(r["taken"] for r in rows) - t) <= max(r["size"] for r in rows)
    assert sorted(map(tuple, op5_mixing(spark, sf).collect())) == sorted(map(tuple, got))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mixed = mix(docs, "source", F.col("size"))
    assert mixed.columns == docs.columns and {r["n"] for r in mixed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()} <= {1, 2}


def test_mixing_repeated_rows(spark, monkeypatch):
    """Repeated ids and null ids are no units: sums come within one document of the targets, and copies are whole rows."""
    from plumbline.llm import op05_mixing as m

    monkeypatch.setattr(m, "COPIES", 50)
    text = "w " * 100
    rows = [("a", 1 if i < 400 else i, text) for i in range(800)] + [("b", None, text)] * 800 + [("c", i, text) for i in range(100)] + [(None, None, None), (None, 3, "")]
    docs = spark.createDataFrame(rows, "source string, doc_id long, text string")
    sizes = {"a": 80_000, "b": 80_000, "c": 10_000, None: 0}
    goal = m.targets(sizes, m.WEIGHTS, 1.5, 2.0)
    mixed = m.mix(docs, "source", F.size(F.split(F.coalesce(F.trim("text"), F.lit("")), " ")) * F.length(F.coalesce("text", F.lit(""))).cast("boolean").cast("int"))
    got = collections.Counter(r["source"] for r in mixed.collect())
    for s in ("a", "b", "c"):
        assert abs(100 * got[s] - goal[s]) <= 100
    each = collections.Counter(r["doc_id"] for r in mixed.filter("source = 'a'").collect())
    assert mixed.columns == docs.columns and abs(each[1] - 400 * goal["a"] / sizes["a"]) <= 1


def test_warc(spark, texts, tmp_path):
    from plumbline.llm.op06_warc import ZipReader, ZipWriter, archive_pages, read_archives

    pages = spark.createDataFrame([(i, f"http://x/{i % 7}", t) for i, t in enumerate(texts)], "page_id long, url string, html string").repartition(3)
    manifest = archive_pages(pages, f"file://{tmp_path}/w")
    got = {r["page_id"]: r for r in read_archives(manifest).collect()}
    first = {}
    for i, t in enumerate(texts):
        payload = (t or "").encode()
        r, at = got[i], first.setdefault(payload, i)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == (len(payload), digest, "response" if at == i else "revisit", None if at == i else at)
        assert (r["payload"] is None) if at != i else bytes(r["payload"]) == payload
    rows = [(4, "x"), (4, "x"), (5, "x"), (None, "x"), (None, "y"), (None, "y"), (None, None), (7, ""), (8, "short")]
    odd = spark.createDataFrame([(i, None, t) for i, t in rows], "page_id long, url string, html string").repartition(4)
    read = lambda least: sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in read_archives(archive_pages(odd, f"file://{tmp_path}/{least}", least)).collect()), key=str)
    assert read(0) == sorted([(4, "response", None), (4, "revisit", 4), (5, "revisit", 4), (None, "revisit", 4), (None, "response", None), (None, "revisit", None), (None, "revisit", 7), (7, "response", None), (8, "response", None)], key=str)
    assert {x[1] for x in read(2)} == {"response"}
    with zipfile.ZipFile(next((tmp_path / "w").glob("*.wacz"))) as z:
        assert z.testzip() is None and len(z.namelist()) == 2
    other = io.BytesIO()
    with zipfile.ZipFile(other, "w") as z:
        z.writestr("a/b", b"stored")
        z.comment = b"PK\5\6 in a comment"
    r = ZipReader(other, len(other.getvalue()))
    at, size = r.place("a/b")
    assert r.read(at, size) == b"stored"
    big = io.BytesIO()
    w = ZipWriter(big)
    w.member("x", iter([b"12", b"3"]))
    w.close()
    assert ZipReader(big, w.at).members == {"x": (0, 3)}


def test_chat(spark):
    from plumbline.llm.op07_chat import PAIR_TEXT, escape, format_trees, read_back, unescape

    nasty = [PAIR_TEXT, "\\b \\l \\\\ < <turn x>\n\n</turn>\n", "", None, "\\", "<"]
    df = spark.createDataFrame([(x or "",) for x in nasty], "t string")
    assert [r[0] for r in df.select(unescape(escape(F.col("t")))).collect()] == [x or "" for x in nasty]
    # A tree: 0 - 1 - 2, 0 - 3 - 4 - 5; a parent that isn't there; one that comes later.
    rows = [(1, 0, None, "user", nasty[0], 0.0), (1, 1, 0, "assistant", nasty[1], 1.0), (1, 2, 1, "a>b<", "x", 1.0), (1, 3, 0, "assistant", None, 5.0), (1, 4, 3, "user", "q", 0.0), (1, 5, 4, "assistant", "r", 9.0), (2, 0, 9, "user", "s", 0.0), (2, 1, 2, "user", "t", 0.0), (2, 2, 1, None, "u", 0.0)]
    trees = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    got = {(r["tree"], r["leaf"]): r for r in read_back(format_trees(trees)).collect()}
    assert set(got) == {(1, 2), (1, 5), (2, 0), (2, 2)}
    assert [tuple(t) for t in got[1, 2]["turns"]] == [("user", nasty[0]), ("assistant", nasty[1]), ("a>b<", "x")] and got[1, 2]["loss_text"] == nasty[1]
    assert [t["text"] for t in got[1, 5]["turns"]] == [nasty[0], "", "q", "r"] and got[1, 5]["loss_text"] == "r" and got[1, 5]["rank"] == 1
    assert [tuple(t) for t in got[2, 2]["turns"]] == [("user", "t"), ("", "u")]
    assert {(r["tree"], r["leaf"]) for r in format_trees(trees, 1).collect()} == {(1, 5), (2, 0)}


def test_decontamination(spark, sf, texts):
    from plumbline.llm.op08_decontaminate import decontaminate, matches, op8_decontamination

    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    item = items.filter("item_id = 1").first()["text"]
    norm = lambda t: [w.strip(".,") for w in (t or "").lower().split()]
    grams = lambda t: {tuple(norm(t)[i : i + 5]) for i in range(len(norm(t)) - 4)}
    expected = {(i, 1) for i, t in enumerate(texts) if len(grams(t) & grams(item)) >= 0.8 * len(grams(item))}
    assert len(expected) > 5 and {(r["doc_id"], r["item_id"]) for r in op8_decontamination(spark, sf).collect()} == expected
    clean = decontaminate(docs, items)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {i for i, _ in expected}
    asked = spark.createDataFrame([(1, "q one two three four five", "yes indeed"), (2, "short", None)], "item_id long, text string, answer string")
    hay = spark.createDataFrame([(1, "so q one two three four five yes indeed"), (2, "so q one two three four five no"), (3, "short")], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in matches(hay, asked, answer="answer").collect()} == {(1, 1), (3, 2)}


def test_decontamination_retrieves_all_above_threshold():
    """Block-max WAND against scores of all (passage, segment) pairs, for an index of several blocks and long items."""
    from plumbline.llm import op08_decontaminate as m

    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)]
    prose = lambda n: [rng.choice(vocabulary[: rng.choice([20, 400])]) for _ in range(n)]
    items = [(i, " ".join(prose(rng.randint(3, 200))), None) for i in range(90)] + [(5, "w1 w2 w3", None), (200, "", None), (201, None, None)]
    index = m.build_index(items)
    texts = []
    for _ in range(60):
        own = rng.choice(items[:90])[1].split()
        cut = [w if rng.random() < 0.75 else rng.choice(vocabulary) for w in own]
        texts.append(" ".join(prose(rng.randint(0, 150)) + cut + prose(rng.randint(0, 90))))
    flat, offsets = m.norm_words(pa.array([None, *texts, ""]))
    found = m.candidates(index, flat, offsets, 0.6)
    words_, terms = flat.to_pylist(), {t: i for i, t in enumerate(index.terms.to_pylist())}
    postings = collections.defaultdict(dict)
    for i, (a, b) in enumerate(zip(index.block_postings[:-1], index.block_postings[1:], strict=True)):
        for k in range(a, b):
            postings[int(index.block_key[i] // index.n_blocks)][int(index.segment[k])] = float(index.impact[k])
    expected, near = set(), 0
    for text, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        for at in range(a, b, m.HALF):
            scores = collections.Counter()
            for t in {terms[w] for w in words_[at : min(b, at + 2 * m.HALF)] if w in terms}:
                scores.update(postings[t])
            expected |= {(text, int(at), index.segment_item[s]) for s, x in scores.items() if x >= 0.6}
            near += sum(0.3 <= x < 0.6 for x in scores.values())
    assert found >= expected and len(found - expected) <= 2 and len(expected) > 60 and near > 100
    own = collections.Counter()
    for t in postings.values():
        own.update(t)
    assert all(math.isclose(x, 1, rel_tol=1e-4) for x in own.values())


def test_decontamination_in_turns(spark, sf, monkeypatch):
    """Statistics are those of all items, so that turns change nothing."""
    from plumbline.llm import op08_decontaminate as m

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    own = [r["text"] for r in docs.filter("length(text) between 60 and 4000").collect()]
    items = spark.createDataFrame([(i, " ".join(t.split()[:40])) for i, t in enumerate(own)], "item_id long, text string")
    once = {tuple(r) for r in m.matches(docs, items).collect()}
    monkeypatch.setattr(m, "WORDS_AT_ONCE", 300)
    assert len(once) >= len(own) and {tuple(r) for r in m.matches(docs, items).collect()} == once


def test_decontamination_index_is_bounded():
    from plumbline.llm import op08_decontaminate as m

    rng = random.Random(2)
    items = [(i, " ".join(f"w{int(rng.paretovariate(0.3)) % 200_000}" for _ in range(60)), None) for i in range(16_000)]
    assert m.build_index(items).n_bytes < 60 * 60 * 16_000


def test_jaccard(spark, sf, texts):
    from plumbline.llm.op09_jaccard import op9_jaccard

    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op9_jaccard(spark, sf).collect()}
    assert got == {i: (len(s), root(i)) for i, s in enumerate(sets)}


def test_jaccard_counts_all_links(spark, tmp_path):
    from plumbline.llm.op09_jaccard import op9_jaccard

    rng = random.Random(9)
    base = [f"w{rng.randrange(1000)}" for _ in range(150)]
    near = []
    for _ in range(80):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        near.append(" ".join(w))
    rows = near + near[:3] * 2 + [None, "", "some other words that are in no group"]
    spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sets = [shingles(t) for t in rows]
    linked = lambda a, b: bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)
    expected = {i: sum(i != j and linked(a, b) for j, b in enumerate(sets)) for i, a in enumerate(sets)}
    assert max(expected.values()) > 32 and len(set(expected.values())) > 5
    assert {r["doc_id"]: r["n_links"] for r in op9_jaccard(spark, str(tmp_path)).collect()} == expected


def test_jaccard_links_rows_without_id(spark):
    from plumbline.llm.op09_jaccard import similar

    w = [f"w{i}" for i in range(100)]
    # The second text is similar to both others, which aren't similar to each other.
    texts = [(1, w), (None, w[8:] + [f"x{i}" for i in range(8)]), (2, w[16:] + [f"x{i}" for i in range(16)])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in similar(docs).collect()} == {(1, 1), (None, 1), (2, 1)}


def test_rtree_finds_all_pairs():
    import numpy as np

    from plumbline.llm import op09_jaccard as m

    rng = np.random.default_rng(1)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 63, rng.integers(5, 90)).astype(np.uint64)
        for _ in range(10):
            s = base.copy()
            s[: rng.integers(0, len(s) // 4 + 1)] = rng.integers(0, 1 << 63)
            sets.append(np.unique(s))
    points = np.stack([np.frombuffer(m._point(s), np.uint8) for s in sets])
    tree = m.RTree(points, np.array([len(s) for s in sets]))
    found = {(int(a), int(b)) for x, y in tree.join(tree) for a, b in zip(x, y, strict=True)}
    for i, s in enumerate(sets):
        for j, t in enumerate(sets):
            common = len(np.intersect1d(s, t))
            if 100 * common >= 80 * (len(s) + len(t) - common):
                assert (i, j) in found or (j, i) in found


def test_fine_vectors_bound_long_sets():
    import numpy as np

    from plumbline.llm import op09_jaccard as m

    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 63, 9_000, dtype=np.uint64))
    shorter, other = base[:7_500], np.unique(rng.integers(0, 1 << 63, 9_000, dtype=np.uint64))
    near = np.unique(np.concatenate([base[:8_200], rng.integers(0, 1 << 63, 300, dtype=np.uint64)]))
    sets = [base, near, shorter, other, base[:2_000]]
    vectors = [m._fine(x) for x in sets]
    assert (len(vectors[0]), len(vectors[2]), vectors[4]) == (2_048, 1_024, None)
    vectors.append(b"\xff" * 1_024)
    x, y = np.array([(0, 1), (0, 2), (0, 3), (2, 3), (1, 2), (0, 4), (0, 5)]).T
    n = np.array([len(s) for s in sets] + [7_500])
    assert m._finely_allowed(vectors, n, x, y).tolist() == [True, True, False, False, True, True, True]


def test_intersections_and_forest_of_a_block(monkeypatch):
    """All pairs of one large place, in blocks and narrow matrices: counts, and components of the forest, by brute force."""
    import numpy as np

    from plumbline.llm import op09_jaccard as m

    monkeypatch.setattr(m, "MATRIX", 1 << 10)
    rng = np.random.default_rng(5)
    bases = [rng.integers(0, 1 << 63, 60, dtype=np.uint64) for _ in range(3)]
    sets = []
    for i in range(700):
        s = bases[i % 3].copy()
        s[rng.choice(60, rng.integers(0, 9), replace=False)] = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
        sets.append(np.unique(s))
    common = m.intersections(sets[:50], sets[:40])
    assert all(common[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(50) for j in range(40))
    n = np.array([len(s) for s in sets])
    linked = np.array([[i != j and 100 * (c := len(np.intersect1d(s, t, assume_unique=True))) >= 80 * (len(s) + len(t) - c) for j, t in enumerate(sets)] for i, s in enumerate(sets)])
    copies, counts = rng.integers(1, 4, 700), np.zeros(700, np.int64)
    # Rows 0, 10, ... share a lesser leader, so that their pairs are counted in another place.
    leaders = pa.array([[3, 7] if i % 10 == 0 else [7] for i in range(700)], pa.list_(pa.int64()))
    forest = m._block(0, 700, sets, n, copies, np.zeros(700, int), 7, leaders, counts)
    tens = np.arange(700) % 10 == 0
    assert (counts == (linked & ~(tens[:, None] & tens[None, :])) @ copies).all()
    a, b = np.concatenate([x for x, _ in forest]), np.concatenate([y for _, y in forest])
    assert linked[a, b].all() and len(a) < 700
    label = np.arange(700)
    for x, y in zip(a, b, strict=True):
        label[label == label[x]] = label[y]
    reach = linked | np.eye(700, dtype=bool)
    for _ in range(10):
        reach = (reach.astype(np.float32) @ reach.astype(np.float32)) > 0
    assert (reach == (label[:, None] == label[None, :])).all()


def test_quality(spark, sf, texts):
    from plumbline.llm.op10_quality import keep_good, op10_quality

    got = {r["doc_id"]: r for r in op10_quality(spark, sf).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = words(t)
        c = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {p for k in range(len(w) - 7) if c[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}
        lines = [x for x in t.split("\n") if words(x)]
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert tuple(got[i][k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == expected
        assert got[i]["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (got[i]["base_failed"] and got[i]["kept"])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert {r["doc_id"] for r in keep_good(docs).collect()} == {i for i, r in got.items() if r["kept"]}


def test_quality_word_test_decides(spark):
    from plumbline.llm.op10_quality import FUNCTION_WORDS, Rules, judge, keep_good

    rng, common = random.Random(7), FUNCTION_WORDS["en"]
    made = lambda n, share: " ".join(rng.choice(common) if rng.random() < share else "".join(rng.choice("aeinrst") for _ in range(6)) for _ in range(n))
    clean, junk = [made(rng.randint(60, 300), 0.3) for _ in range(60)], [made(120, 0) for _ in range(6)]
    rows = [(i, t, "en") for i, t in enumerate(clean + junk + junk[:1] * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in judge(docs).collect()}
    bad = set(range(60, len(rows)))
    assert {i for i, r in got.items() if not r["kept"]} == bad
    assert not any(got[i]["base_failed"] or got[i]["class_distance"] > Rules().class_bound for i in bad)
    assert {r["doc_id"] for r in keep_good(docs).collect()} == set(range(60))


def jensen_shannon(counts, reference):
    total, mass = sum(counts), sum(reference)
    p, q = [x / total for x in counts], [x / mass for x in reference]
    term = lambda a, b: a * math.log2(a / ((a + b) / 2)) if a > 0 else 0.0
    return math.sqrt(max(0.0, sum(term(a, b) + term(b, a) for a, b in zip(p, q, strict=True)) / 2))


def test_quality_distances(spark, tmp_path):
    """Both distances, bounds and verdicts of op10_quality by brute force, over languages with and without a word test."""
    from plumbline.llm.op10_quality import FUNCTION_WORDS, Rules, op10_quality

    import regex

    rng, rules = random.Random(11), Rules()
    rows = []
    for i in range(260):
        lang = ["en", "de", "xx", None][i % 4]
        common = FUNCTION_WORDS.get(lang, ["zu", "la"])
        share = 0.3 if i % 13 else 0.0
        word = lambda: rng.choice(common) if rng.random() < share else rng.choice(["%d" % rng.randrange(10**6), "x#$", "Wort,", "abel", "quu.", "Und", "éa"])
        rows.append((i, " ".join(word() for _ in range(rng.choice([5, 24, 25, 49, 50, 120]))), lang))
    rows += [(260, None, "en"), (261, "", "en"), (262, " ".join("#%d$&" % k for k in range(90)), "en"), (263, rows[5][1], "de")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op10_quality(spark, str(tmp_path)).collect()}
    known, classes, common, n = {}, {}, {}, {}
    for i, text, lang in rows:
        text = text or ""
        w, k = words(text), lang if lang in FUNCTION_WORDS else ""
        rare = [len(regex.findall(p, text)) for p in (r"\p{Lu}", "[0-9]", r"[.,;:!?'\"()\-]", r"[#*$%&|<>]")]
        chars = sum(map(len, w))
        classes[i] = [max(0, chars - sum(rare)), len(text) - chars, *rare]
        found = [x.lower() for x in w if x in {y for f in FUNCTION_WORDS.get(lang, []) for y in (f, f.capitalize())}]
        common[i] = [found.count(f) for f in FUNCTION_WORDS.get(lang, [])] + [len(w) - len(found)]
        known[i], n[i] = k, (len(w), len(text))
    mean = lambda rows: [sum(c) / len(rows) for c in zip(*rows, strict=True)]
    far_c, far_w, by = {}, {}, collections.defaultdict(set)
    for k in set(known.values()):
        own = [i for i in known if known[i] == k and n[i][0] >= rules.least_words]
        ref_c, ref_w = mean([[x / n[i][1] for x in classes[i]] for i in own]), mean([[x / n[i][0] for x in common[i]] for i in own])
        for i in (i for i in known if known[i] == k):
            far_c[i] = jensen_shannon(classes[i], ref_c) if sum(classes[i]) else 0.0
            far_w[i] = jensen_shannon(common[i], ref_w) if k and sum(common[i]) else 0.0
            if k and n[i][0] >= rules.word_least_words:
                by[k].add(round(far_w[i], 6))
    bounds = {}
    for k, distances in by.items():
        bins = sorted(math.floor(d * 1000) for d in distances)
        low, high = ((bins[max(0, math.ceil(len(bins) * p / 4) - 1)] + 0.5) / 1000 for p in (1, 3))
        bounds[k] = high + rules.word_fence * (high - low) if len(bins) >= rules.word_least_texts else rules.word_bound
    for i in known:
        r = got[i]
        assert math.isclose(r["class_distance"], far_c[i], abs_tol=1e-9) and math.isclose(r["word_distance"], far_w[i], abs_tol=1e-9), i
        far = (far_c[i] > rules.class_bound and n[i][0] >= rules.class_least_words) or (far_w[i] > bounds.get(known[i], rules.word_bound) and n[i][0] >= rules.word_least_words)
        assert r["kept"] == (not r["base_failed"] and not far), i
    assert {r["kept"] for r in got.values() if not r["base_failed"]} == {True, False}


def test_oracles(spark):
    """Queries that SQL can express, against DuckDB."""
    import duckdb

    from plumbline.llm.queries import ORACLES, QUERIES

    at, db = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        db.execute(f"create view {t} as select * from '{at}/{t}.parquet'")
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, at)
        columns, found = sorted(df.columns), db.execute(sql)
        names = [d[0] for d in found.description]
        assert sorted(names) == columns, name
        expected = sorted((tuple(plain(x[names.index(c)]) for c in columns) for x in found.fetchall()), key=str)
        assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str) == expected and expected, name


def test_pipeline(spark, sf, texts):
    """Each stage by brute force on what the one before it kept."""
    import corpus_pipeline as p

    from plumbline.llm.op10_quality import judge

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, ids = docs.columns, lambda df: sorted(r["doc_id"] for r in df.collect())
    kept = p.written(p.quality(spark, docs, sf), "quality")
    expected = ids(judge(docs).filter("kept"))
    assert kept.columns == columns and ids(kept) == expected and 0 < len(expected) < len(texts)
    sets = {i: shingles(texts[i]) for i in expected}
    left, chosen = set(expected), set()
    while left:
        group, open_ = set(), {min(left)}
        while open_:
            i = open_.pop()
            group.add(i)
            open_ |= {j for j in left - group if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
        chosen.add(min(group))
        left -= group
    single = p.written(p.near_duplicates(spark, kept, sf), "single")
    assert single.columns == columns and ids(single) == sorted(chosen) and len(chosen) < len(expected)
    item = spark.read.parquet(f"{sf}/benchmark.parquet").filter("item_id = 1").first()["text"]
    norm = lambda t: [w.strip(".,") for w in (t or "").lower().split()]
    grams = lambda t: {tuple(norm(t)[i : i + 5]) for i in range(len(norm(t)) - 4)}
    clean = p.written(p.decontamination(spark, single, sf), "clean")
    clean_ids = sorted(i for i in chosen if len(grams(texts[i]) & grams(item)) < 0.8 * len(grams(item)))
    assert clean.columns == columns and ids(clean) == clean_ids and len(clean_ids) < len(chosen)
    mixed = p.written(p.mixing(spark, clean, sf), "mixed")
    from plumbline.llm.op05_mixing import WEIGHTS, targets

    rows = {r["doc_id"]: r for r in clean.collect()}
    sizes, most = collections.Counter(), collections.Counter()
    for r in rows.values():
        n = len(words(r["text"]))
        sizes[r["source"]] += n
        most[r["source"]] = max(most[r["source"]], n)
    took = collections.Counter(ids(mixed))
    assert mixed.columns == columns and set(took) <= set(rows) and max(took.values()) <= 2
    for s, goal in targets(sizes, WEIGHTS, 1.5, 2.0).items():
        assert abs(sum(k * len(words(rows[i]["text"])) for i, k in took.items() if rows[i]["source"] == s) - goal) <= most[s]
    out = p.sharding(spark, mixed, sf).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == sorted((i, len((texts[i] or "").encode()) + 16, zlib.crc32((texts[i] or "").encode())) for i in took.elements())
    slots = collections.defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert collections.Counter(ids(p.run(spark, sf))) == took
