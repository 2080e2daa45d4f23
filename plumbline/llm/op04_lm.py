"""LM scoring by online logistic context mixing of bit predictors.

A text is a sequence of tokens: its words, in lower case A-Z, and one end. A token is coded in bits: the CODED most
frequent words, the end and an escape by their paths in a Huffman tree, and after the escape a word byte by byte, a
space at its end. Each bit is predicted by several hashed contexts: of a path's bit the class of text so far,
the last word, and the last two; of a byte's bit the last 3 and 4 bytes and all of the word so far. A predictor
is a pair of counts, of zeros and ones, in a hash table of fixed size, which all training texts are counted in (spelled
words once each). The predictions are combined in the logistic domain by weights that a gate (how much the two longest contexts have seen)
selects, and a probability map refines the result; a task learns both online from every bit that it counts, each predicted
from what the task has counted before, and the tasks' results are averaged by how many bits they saw.

While a text is scored, two things adapt to it: the class of text, which the words before a token decide, and a cache of
the text's own earlier tokens, which is mixed in by a share that depends on how many there are. A text's bits per byte
are its score in bits over its length.

Words' own counts (for the base score) are exact: those of coded words are broadcast (a table of bounded size), the
others are joined by word, where no word is frequent.

Defined results: null and empty texts are one end; a null id counts as the empty text for the split; repeated rows
are learned from and scored each; with no training texts all counts are 0; bits_per_byte of a text without bytes is
null; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import text_or_empty, written
from .shingles import distinct_hashes, flat_words, mixed, slices, sparing, word_hashes

#: Words that have a code of their own, at most; classes of training texts that are told apart, at most.
CODED, CLASSES = 1 << 18, 8
#: Bits of the tables of hashed contexts: the last word, the last two; 3 and 4 bytes, the word so far.
WORD_BITS, BYTE_BITS = (22, 22), (20, 20, 21)
_WORD_AT = (CLASSES + 1) * (CODED + 2) + np.concatenate([[0], np.cumsum([1 << b for b in WORD_BITS])])
_BYTE_AT = np.concatenate([[0], np.cumsum([1 << b for b in BYTE_BITS])])
_WORD_BITS, _BYTE_BITS = (np.array(bits, np.uint32)[:, None] for bits in (WORD_BITS, BYTE_BITS))
#: Slots of a path's bits, then those of bytes' bits; slots of a block that counts are summed in.
BLOCK = 1 << 16
WORD_SLOTS, BYTE_SLOTS = (-(-int(at[-1]) // BLOCK) * BLOCK for at in (_WORD_AT, _BYTE_AT))
#: A gate's steps of a context's count; buckets of the map; buckets of a text's length for the cache's share.
STEPS, BUCKETS, AGES = np.array([1, 4, 32]), 49, 24
GATES = (len(STEPS) + 1) ** 2
#: Bits that weights are updated after.
STEP_BITS = 1 << 13
#: Distinct words that a task counts before it hands them on; words that a worker keeps spellings' scores of.
HELD, CACHE = 1_000_000, 200_000
#: Bytes of texts that a task makes tokens of at a time; tokens that are looked at together, and bits that a task counts before it hands its counts on.
SLICE, CHUNK, MOST_BITS = 2 << 20, 1 << 14, 1 << 31
#: Tokens, or bits, that arithmetic is done on together where results don't depend on it: few calls, and arrays that a cache holds.
SCORED = 1 << 15
END = " "
#: log of the probability that a spelling counts as while the cache's share is learned.
SPELLED = -16.0


#: A zero and a one as a cell counts them; what a bit counts as where its share is added (more than the shares of a step's bits come to).
_MORE, _WHOLE = np.array([1, 1 << 32], np.uint64), np.float64(1 << 20)

#: Each count's step, up to the last one; lanes that a gate's sums are made in.
_STEP = np.searchsorted(STEPS, np.arange(STEPS[-1] + 1), side="right")
LANES = 4
_LANES = np.arange(STEP_BITS) % LANES * GATES


def _step(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(STEPS, n, side="right")


def _stretch(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4))).astype(np.float32)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


def _within(x: np.ndarray, most: float) -> np.ndarray:
    """x, in place, as far from 0 as most; two plain passes take half of np.clip's time."""
    np.minimum(x, np.float32(most), out=x)
    return np.maximum(x, np.float32(-most), out=x)


def _bucket(dot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets' points are half a unit apart, from -12 to 12. dot is overwritten."""
    x = _within(dot, 11.99)
    x *= np.float32(2)
    x += np.float32(BUCKETS // 2)
    low = np.floor(x)
    x -= low
    return low.astype(np.intp), x


@dataclass
class Mixer:
    """Weights (context, gate) and the map (gate, bucket): the probability at each of its buckets' points."""

    weights: np.ndarray
    map_: np.ndarray

    def bits(self, packed: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """Probabilities of bits; packed: a row of each context's slots of a model's table."""
        step = packed[-2:] & 3
        gate = (step[0] * np.int16(len(STEPS) + 1) + step[1]).astype(np.intp)
        parts = self.weights.take(gate, axis=1, mode="clip")
        parts *= (packed >> 2).astype(np.float32)
        dot = np.add.reduce(parts)
        dot *= np.float32(1 / 256)
        low, part = _bucket(dot)
        gate *= BUCKETS
        low += gate
        flat = self.map_.reshape(-1)
        p = flat.take(low, mode="clip")
        low += 1
        more = flat.take(low, mode="clip")
        more -= p
        more *= part
        p += more
        p -= (1 - ones).astype(np.float32)
        return np.abs(p, out=p)


class Learner:
    """A task's counts of one kind of bits, and the weights and the map that it learns online, from every bit."""

    def __init__(self, slots: int, contexts: int):
        # A slot's zeros and ones share a cell, so that one gather brings both.
        self.counts = np.zeros((slots, 2), "<u4")
        self.cells = self.counts.reshape(-1).view("<u8")
        self.slots, self.counted = slots, 0
        self.weights = np.full((contexts, GATES), 1.2 / contexts, np.float32)
        self.squares = np.full((contexts, GATES), 1e-2)
        # Bits, and their shares of the next bucket, by gate, bucket and value.
        self.bits, self.shares = np.zeros((2, GATES * BUCKETS * 2))

    def learn(self, slots: np.ndarray | list[np.ndarray], ones: np.ndarray) -> np.ndarray:
        """log probabilities of bits before they are counted."""
        return np.log(self.count(slots, ones))

    def count(self, slots: np.ndarray | list[np.ndarray], ones: np.ndarray) -> np.ndarray:
        """Probabilities of bits before they are counted; the weights and the map learn from each STEP_BITS of them, then they are counted."""
        out = np.empty(len(ones), np.float32)
        for at in range(0, len(ones), STEP_BITS):
            part = slice(at, at + STEP_BITS)
            one = ones[part]
            more, cells = _MORE.take(one, mode="clip"), np.empty((len(slots), len(one)), "<u8")
            for own, seen in zip(slots, cells, strict=True):
                self.cells.take(own[part], out=seen, mode="clip")
            for own in reversed(slots):  # the last one's lines are still in the processor's cache
                np.add.at(self.cells, own[part], more)
            seen = cells.view("<u4").astype(np.float32)
            seen += np.float32(0.4)
            st = seen[:, 1::2] / seen[:, ::2]
            np.log(st, out=st)
            total = seen[-2:, ::2] + seen[-2:, 1::2]  # 0.8 more than the count, which gets lost in the table's index
            np.minimum(total, np.float32(STEPS[-1] + 0.9), out=total)
            step = _STEP.take(total.astype(np.intp), mode="clip")
            gate = step[0] * (len(STEPS) + 1)
            gate += step[1]
            parts = self.weights.take(gate, axis=1, mode="clip")
            parts *= st
            dot = np.add.reduce(parts)
            sign = one.astype(np.float32)
            sign *= np.float32(2)
            sign -= np.float32(1)
            odds = _within(sign * dot, 13.8)
            np.exp(odds, out=odds)
            error = 1 / (1 + odds)
            np.multiply(odds, error, out=out[part])
            error *= sign
            st *= error
            # Sums of a gate in lanes, since each addition to a sum waits for the one before.
            lanes = gate + _LANES[: len(gate)] + np.arange(len(st))[:, None] * (LANES * GATES)
            step = np.bincount(lanes.ravel(), st.ravel(), len(st) * LANES * GATES).reshape(-1, LANES, GATES).sum(1)
            self.squares += step * step
            self.weights += 0.1 * step / np.sqrt(self.squares)
            low, rest = _bucket(dot)
            gate *= BUCKETS
            low += gate
            low *= 2
            low += one
            # One sum brings the bits and their shares, which are below 1 each.
            both = np.bincount(low, rest + _WHOLE, len(self.bits))
            bits = np.floor(both / _WHOLE)
            self.bits += bits
            self.shares += both - bits * _WHOLE
        self.counted += len(ones)
        return out

    def blocks(self, first: int) -> Iterator[pa.RecordBatch]:
        """(block, zeros, ones) of each block that has any counts, in as few bytes as they need; then all are 0 again."""
        for at in range(0, self.slots, BLOCK):
            part = self.counts[at : at + BLOCK]
            if part.any():
                part = (part.astype(np.uint16) if part.max() < 1 << 16 else part).T
                yield pa.RecordBatch.from_pydict({"block": pa.array([first + at // BLOCK], pa.int32()), "zeros": [part[0].tobytes()], "ones": [part[1].tobytes()]})
        self.counts[:] = 0
        self.counted = 0

    def state(self, block: int, more: np.ndarray) -> pa.RecordBatch:
        """What was learned, as a row of its own: sums that tasks' rows can be added up to."""
        bits, shares = (x.reshape(GATES, BUCKETS, 2) for x in (self.bits, self.shares))
        shared = bits - shares
        shared[:, 1:] += shares[:, :-1]
        hits, total, seen = shared[:, :, 1], shared.sum(2), bits.sum((1, 2))
        sums = np.concatenate([(self.weights.T * seen[:, None]).ravel(), seen, hits.ravel(), total.ravel(), more])
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "zeros": [sums.tobytes()], "ones": [b""]})


def _mixer(sums: np.ndarray | None, contexts: int) -> tuple[Mixer, np.ndarray]:
    """The tasks' mean weights, the mean of their joint map and of the logistic function, and what else they summed."""
    identity = np.tile(_squash((np.arange(BUCKETS) - BUCKETS // 2) / 2), (GATES, 1))
    weights, map_, more = np.full((GATES, contexts), 1.2 / contexts), identity, np.zeros(2 * AGES)
    if sums is not None:
        w, seen, hits, total, more = np.split(sums, np.cumsum([GATES * contexts, GATES, GATES * BUCKETS, GATES * BUCKETS]))
        w, hits, total = w.reshape(GATES, -1), hits.reshape(GATES, -1), total.reshape(GATES, -1)
        weights = np.where(seen[:, None] > 0, w / np.maximum(seen, 1)[:, None], weights)
        map_ = (identity + (hits + 50 * identity) / (total + 50)) / 2
    return Mixer(np.ascontiguousarray(weights.T, np.float32), np.clip(map_, 1e-6, 1 - 1e-6).astype(np.float32)), more


def _hashed(contexts: np.ndarray, node: np.ndarray, bits: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
    """The slots of nodes in hashed contexts (a row each), in tables of so many bits that begin there, into out."""
    for first in range(0, len(node), SCORED):
        part = slice(first, first + SCORED)
        x, to = contexts[:, part] ^ (node[part] * np.uint32(0x9E3779B1)), out[:, part]
        x *= np.uint32(0x85EBCA6B)
        x >>= np.uint32(32) - bits
        to[:] = x
        to += at[: len(out), None]


def byte_bits(words: list[str]) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """The word that each byte of the words and their ends belongs to; and for each of 8 bits its values and slots."""
    data = np.frombuffer(b" ".join(w.encode() for w in words) + b" ", np.uint8)
    last = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], last[:-1] + 1])
    word = np.repeat(np.arange(len(words)), np.diff(np.append(starts, len(data))))
    place, wide = np.arange(len(data)) - starts[word], data.astype(np.uint64)
    before, contexts = np.zeros(len(data), np.uint64), []
    for back in range(1, 5):
        byte = np.zeros(len(data), np.uint64)
        byte[back:] = wide[:-back]
        byte[place < back] = 0
        before |= byte << np.uint64(8 * (back - 1))
        if back > 2:
            contexts.append((mixed(before + np.uint64(back << 40)) >> np.uint64(32)).astype(np.uint32))
    # A hash of each prefix, a byte of every word at a time.
    prefix, at = np.zeros(len(data), np.uint64), starts
    while len(at):
        at = at[data[at] != 32]
        prefix[at + 1] = mixed(prefix[at] * np.uint64(0x9E3779B97F4A7C15) + wide[at] + np.uint64(1))
        at = at + 1
    contexts.append((prefix >> np.uint64(32)).astype(np.uint32))

    def bits():
        all_, marked = np.stack(contexts), data.astype(np.uint32) | np.uint32(256)
        for bit in range(8):
            slots = np.empty((len(BYTE_BITS), len(data)), np.intp)
            _hashed(all_, marked >> np.uint32(8 - bit), _BYTE_BITS, _BYTE_AT, slots)
            yield ((data >> np.uint8(7 - bit)) & np.uint8(1)).astype(np.int64), slots

    return word, bits()


@dataclass
class Codebook:
    """Coded words, by their sorted hashes; the tree, each node's parent times 2 plus its side; leaves' depths, evidence of classes."""

    hashes: np.ndarray
    counts: np.ndarray
    ends: int
    up: np.ndarray
    depth: np.ndarray
    evidence: np.ndarray
    prior: np.ndarray

    @property
    def end(self) -> int:
        return len(self.hashes)

    @property
    def escape(self) -> int:
        return len(self.hashes) + 1

    @staticmethod
    def of(hashes: np.ndarray, counts: np.ndarray, by_class: np.ndarray, ends: int, rare: int, texts: np.ndarray) -> "Codebook":
        """hashes: sorted; by_class: counts of (word, class); rare: tokens that aren't coded; texts: of each class."""
        weight = np.concatenate([counts, [ends + 1, rare + 1]])
        n = len(weight)
        parent, side = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int64)
        heap = [(int(w), k) for k, w in enumerate(weight)]
        heapq.heapify(heap)
        for node in range(n, 2 * n - 1):
            (v, a), (w, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[a] = parent[b] = node
            side[b] = 1
            heapq.heappush(heap, (v + w, node))
        sums = np.maximum(1, by_class.sum(0))
        share = np.log((by_class + 0.5) / (sums + 0.5 * len(hashes)))
        evidence = np.concatenate([share - share.mean(1, keepdims=True) if share.shape[1] else share, np.zeros((2, by_class.shape[1]))]).T
        depth = np.zeros(2 * n - 1, np.uint8)
        for node in range(2 * n - 3, -1, -1):
            depth[node] = depth[parent[node]] + 1
        return Codebook(hashes, counts, ends, parent * 2 + side, depth[:n], np.ascontiguousarray(evidence, np.float32), np.log(np.maximum(1, texts) / max(1, texts.sum())))

    def paths(self, tokens: "Tokens", part: slice) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
        """The tokens of a part, long paths first; and for each level of the tree, from the leaves up, the bits of the first
        of them (as many as reach it) and the bits' slots."""
        depth = self.depth[tokens.leaf[part]]
        order = np.argsort(-depth.astype(np.int8), kind="stable")
        sizes = np.cumsum(np.bincount(depth)[::-1])[::-1]  # tokens of so many bits or more

        def levels():
            node, own = tokens.leaf[part][order], order + part.start
            klass, contexts, first = tokens.klass[own] * (CODED + 2), np.stack([c[own] for c in tokens.contexts]), len(self.hashes) + 2
            for n in sizes[1:].tolist():
                up = self.up.take(node[:n], mode="clip")
                side, node = up & 1, up >> 1
                inner = node - first
                slots = np.empty((1 + len(WORD_BITS), n), np.intp)
                np.add(klass[:n], inner, out=slots[0])
                _hashed(contexts[:, :n], inner.astype(np.uint32), _WORD_BITS, _WORD_AT, slots[1:])
                yield side, slots

        return order + part.start, levels()


@dataclass
class Tokens:
    """The tokens of some texts, an end after each: leaf, class of text so far, hashes of contexts; distinct words too."""

    words: pa.Array
    code: np.ndarray
    place: np.ndarray
    text: np.ndarray
    age: np.ndarray
    leaf: np.ndarray
    klass: np.ndarray
    contexts: list[np.ndarray]
    hash: np.ndarray

    @staticmethod
    def of(texts: pa.Array, book: Codebook) -> "Tokens":
        """code: each token's distinct word, or the number of them for an end; place: each distinct word's in the codebook, or -1."""
        flat, offsets = flat_words(texts)
        coded = flat.dictionary_encode()
        h = distinct_hashes(coded.dictionary)
        n, sizes = len(h), np.diff(offsets) + 1
        ends = np.cumsum(sizes) - 1
        code = np.full(int(sizes.sum()), n, np.int64)
        inner = np.ones(len(code), bool)
        inner[ends] = False
        code[inner] = coded.indices.to_numpy(zero_copy_only=False)
        place = _find(book.hashes, h)
        leaf = np.append(np.where(place >= 0, place, book.escape), book.end)[code]
        text = np.repeat(np.arange(len(sizes)), sizes)
        age = np.arange(len(code)) - (ends - sizes + 1)[text]
        hash_ = np.append(h, np.uint64(0))[code]
        short = (hash_ >> np.uint64(32)).astype(np.uint32)
        last, both = np.zeros(len(code), np.uint32), np.zeros(len(code), np.uint32)
        last[1:], both[2:] = short[:-1], short[:-2]
        last[age < 1], both[age < 2] = 0, 0
        both = (last * np.uint32(0xC2B2AE35)) ^ ((both * np.uint32(0x27D4EB2F)) >> np.uint32(3)) ^ np.uint32(0x5BD1E995)
        # The class whose evidence from the words before is the best; sums are of whole runs of texts, less what came before a text.
        klass, most = np.zeros(len(code), np.int64), np.full(len(code), -np.inf)
        for k, row in enumerate(book.evidence):
            own = row[leaf]
            value = np.cumsum(own, dtype=np.float64) - own
            value -= np.repeat(value[ends - sizes + 1] - book.prior[k], sizes)
            np.copyto(klass, k + 1, where=value > most)
            np.maximum(most, value, out=most)
        return Tokens(coded.dictionary, code, place, text, age, leaf, klass, [last, both], hash_)

    def cached(self) -> np.ndarray:
        """log of each token's share of the text's earlier tokens; ends, and what hasn't come, have none."""
        # Sorted by distinct word and place: a run of one word in one text is its occurrences in order.
        places = np.arange(len(self.code))
        bits = len(places).bit_length()
        sorted_ = np.sort((self.code << bits) | places)
        code, place = sorted_ >> bits, sorted_ & ((1 << bits) - 1)
        text = self.text[place]
        first = np.ones(len(places), bool)
        first[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
        rank = np.empty(len(places), np.int64)
        rank[place] = places - np.maximum.accumulate(np.where(first, places, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where((rank > 0) & (self.code < len(self.words)), np.log(rank / np.maximum(1, self.age)), -np.inf)

    def ages(self) -> np.ndarray:
        of = np.log2(np.maximum(1, np.arange(self.age.max(initial=0) + 1)) * 2).astype(np.int64)
        of[0] = 0
        return np.minimum(AGES - 1, of).take(self.age, mode="clip")


def _find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of values in a sorted table, -1 where they aren't."""
    if not len(table):
        return np.full(len(values), -1)
    # In order, so that neighbours' searches go the same ways.
    order = np.argsort(values)
    values = values[order]
    place = np.minimum(np.searchsorted(table, values), len(table) - 1)
    out = np.empty(len(values), np.int64)
    out[order] = np.where(table[place] == values, place, -1)
    return out


def _log_product(n: int, levels: Iterator[tuple[int, np.ndarray]]) -> np.ndarray:
    """log of the product of n rows' probabilities (1e-6 at least); levels: how many of the first rows have one, and these."""
    out, product = np.zeros(n), np.ones(n)
    for k, (m, p) in enumerate(levels, 1):
        product[:m] *= p
        if k % 32 == 0:  # a double holds so many
            out += np.log(product)
            product[:] = 1
    return out + np.log(product)


@dataclass
class Model:
    """table: each slot's prediction (256ths, times 4) and its count's step; mixers; each age's share of the cache."""

    book: Codebook
    table: np.ndarray
    words: Mixer
    bytes: Mixer
    share: np.ndarray

    def spell(self, words: list[str]) -> np.ndarray:
        """log probabilities of words, each with its end, byte by byte."""
        out = np.zeros(len(words))
        for at in range(0, len(words), CHUNK):
            some = words[at : at + CHUNK]
            word, bits = byte_bits(some)
            table, total = self.table[WORD_SLOTS:], np.ones(len(word))
            for ones, slots in bits:
                for first in range(0, len(total), SCORED):
                    part = slice(first, first + SCORED)
                    total[part] *= self.bytes.bits(table.take(slots[:, part], mode="clip"), ones[part])
            out[at : at + len(some)] = np.bincount(word, np.log(total, out=total), len(some))
        return out

    def code(self, tokens: Tokens) -> np.ndarray:
        """log probabilities of the tokens' paths."""
        out = np.zeros(len(tokens.code))
        for first in range(0, len(out), SCORED):
            order, levels = self.book.paths(tokens, slice(first, min(first + SCORED, len(out))))
            out[order] = _log_product(len(order), ((len(ones), self.words.bits(self.table.take(slots, mode="clip"), ones)) for ones, slots in levels))
        return out

    def score(self, tokens: Tokens, spelled: np.ndarray) -> np.ndarray:
        """log probabilities of the tokens; spelled: those of the distinct words' spellings (0 where a word is coded)."""
        own = self.code(tokens) + np.append(spelled, 0.0)[tokens.code]
        age = tokens.ages()
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log1p(-self.share).take(age) + own, np.log(self.share).take(age) + tokens.cached())


_STATES = (1 << 20, 1 << 20 | 1)


@sparing
def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, class, n) of texts (text, class): a task's counts, the end among them."""
    held, rows = [], 0

    def summed() -> pa.Table:
        table = pa.concat_tables(held).group_by(["word", "class"]).aggregate([("n", "sum")])
        return pa.table({"word": table["word"], "class": table["class"], "n": table["n_sum"]}).combine_chunks()

    for whole in batches:
        for batch in slices(whole, 0):
            for k in pc.unique(batch.column(1)).to_pylist():
                own = batch.column(0).filter(pc.equal(batch.column(1), k))
                seen = pc.value_counts(flat_words(own)[0])
                words = pa.concat_arrays([seen.field("values"), pa.array([END])])
                n = pa.concat_arrays([seen.field("counts"), pa.array([len(own)], pa.int64())])
                held.append(pa.table({"word": words, "class": pa.array(np.full(len(words), k, np.int32)), "n": n}))
                rows += len(words)
            if rows > HELD:
                held = [summed()]
                rows = held[0].num_rows
                if rows > HELD // 2:
                    yield from held[0].to_batches()
                    held, rows = [], 0
    if held:
        yield from summed().to_batches()


def _count_paths(shared):
    """Counts of the bits of coded tokens, and what is learned from them, from texts (text)."""

    @sparing
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book: Codebook = shared.value
        learner, ages = Learner(WORD_SLOTS, 1 + len(WORD_BITS)), np.zeros((2, AGES))
        share = np.full(AGES, 0.05)
        for whole in batches:
            for batch in slices(whole, 0, SLICE):
                if not batch.num_rows:
                    continue
                tokens = Tokens.of(batch.column(0), book)
                log_p, cached, of_age = np.zeros(len(tokens.code)), tokens.cached(), tokens.ages()
                for first in range(0, len(log_p), CHUNK):
                    order, levels = book.paths(tokens, slice(first, min(first + CHUNK, len(log_p))))
                    log_p[order] = _log_product(len(order), ((len(ones), learner.count(slots, ones)) for ones, slots in levels))
                old = tokens.age > 0
                log_p[tokens.leaf == book.escape] += SPELLED
                odds = np.log(share / (1 - share))[of_age[old]] + cached[old] - log_p[old]
                ages[0] += np.bincount(of_age[old], _squash(odds), AGES)
                ages[1] += np.bincount(of_age[old], minlength=AGES)
                share = np.clip((ages[0] + 1) / (ages[1] + 20), 1e-4, 0.9)
                if learner.counted > MOST_BITS:
                    yield from learner.blocks(0)
        yield from learner.blocks(0)
        yield learner.state(_STATES[0], ages.ravel())

    return count


@sparing
def _count_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the bits of words that are spelled, each distinct one once, and what is learned from them, from rows (word)."""
    learner = Learner(BYTE_SLOTS, len(BYTE_BITS))
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            _, bits = byte_bits(batch.column(0).slice(at, CHUNK).to_pylist())
            for ones, slots in bits:
                learner.count(slots, ones)
            if learner.counted > MOST_BITS:
                yield from learner.blocks(WORD_SLOTS // BLOCK)
    yield from learner.blocks(WORD_SLOTS // BLOCK)
    yield learner.state(_STATES[1], np.zeros(0))


@sparing
def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, packed predictions) from rows that are sorted by block, or the sums of a state; one is held at a time."""
    at, total = None, None

    def out() -> pa.RecordBatch:
        value = total.tobytes() if at in _STATES else packed(*total).tobytes()
        return pa.RecordBatch.from_pydict({"block": pa.array([at], pa.int32()), "value": [value]})

    for batch in batches:
        for block, zeros, ones in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            if block in _STATES:
                part = np.frombuffer(zeros.as_buffer(), np.float64)
            else:
                part = np.stack([np.frombuffer(x.as_buffer(), np.uint8) for x in (zeros, ones)])
                part = part.view(np.uint16 if part.shape[1] == 2 * BLOCK else np.uint32).astype(np.float64)
            if block != at:
                if at is not None:
                    yield out()
                at, total = block, part.copy()
            else:
                total += part
    if at is not None:
        yield out()


def packed(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """A slot's prediction in 256ths of the logistic domain, times 4, plus the step of its count."""
    st = np.log((ones + 0.4) / (zeros + 0.4))
    return ((np.round(np.clip(st, -12, 12) * 256).astype(np.int32) << 2) + _step(zeros + ones)).astype(np.int16)


def learn_words(training: DataFrame) -> DataFrame:
    """(word, c, by) over all training texts (text, class): counts of words, the end among them, and by class (up to CLASSES)."""
    parts = training.mapInArrow(_count_words, "word string, class int, n long").groupBy("word", "class").agg(F.sum("n").alias("n"))
    by = F.collect_list(F.when(F.col("class") >= 0, F.struct("class", "n")))
    return written(parts.groupBy("word").agg(F.sum("n").alias("c"), F.sort_array(by).alias("by")), "lm-words")


def _least_coded(words: DataFrame) -> int:
    """The least count of a coded word: with it, CODED words at most are coded. Bins of counts come to the driver."""
    bins = words.filter("c > 1").groupBy(F.floor(F.log2("c") * 64).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least"))
    least, n = 1 << 62, 0
    for r in sorted(bins.collect(), key=lambda r: -r["bin"]):
        n += r["n"]
        if n > CODED:
            break
        least = r["least"]
    return least


def make_codebook(words: DataFrame, tokens: int, texts: np.ndarray) -> tuple[Codebook, int]:
    """The codebook of words (word, c, by), and the least count of a word in it; texts: training texts of each class."""

    def of_class(k: int):
        return F.coalesce(F.get(F.filter("by", lambda x: x["class"] == k), F.lit(0))["n"], F.lit(0))

    least = _least_coded(words)
    chosen = words.filter((F.col("c") >= least) & (F.col("word") != END)).select("word", "c", *(of_class(k).alias(f"c{k}") for k in range(len(texts)))).toArrow()
    names = chosen["word"].combine_chunks().cast(pa.string()) if chosen.num_rows else pa.array([], pa.string())
    hashes = word_hashes(names)
    order = np.argsort(hashes)
    by = np.stack([chosen[f"c{k}"].to_numpy() for k in range(len(texts))], 1)[order] if len(texts) else np.zeros((len(order), 0))
    counts = chosen["c"].to_numpy()[order]
    ends = words.filter(F.col("word") == END).select("c").first()
    ends = ends["c"] if ends else 0
    return Codebook.of(hashes[order], counts, by, ends, tokens - ends - int(counts.sum()), texts), least


def learn_model(training: DataFrame, words: DataFrame, book: Codebook, least: int) -> Model:
    """The model of training texts (text); words: their counts. Tables of fixed size come to the driver."""
    spark = training.sparkSession
    shared = spark.sparkContext.broadcast(book)
    few = max(1, 2 * spark.sparkContext.defaultParallelism)
    schema = "block int, zeros binary, ones binary"
    rare = words.filter((F.col("c") < least) & (F.col("word") != END)).select("word")
    parts = training.coalesce(few).mapInArrow(_count_paths(shared), schema).unionByName(rare.coalesce(few).mapInArrow(_count_bytes, schema))
    got = parts.repartition("block").sortWithinPartitions("block").mapInArrow(_sum_blocks, "block int, value binary").toArrow()
    shared.unpersist()
    table, states = np.zeros(WORD_SLOTS + BYTE_SLOTS, np.int16), {}
    for block, value in zip(got["block"].to_pylist(), got["value"], strict=True):
        if block in _STATES:
            states[block] = np.frombuffer(value.as_buffer(), np.float64)
        else:
            part = np.frombuffer(value.as_buffer(), np.int16)
            table[block * BLOCK : block * BLOCK + len(part)] = part
    path, ages = _mixer(states.get(_STATES[0]), 1 + len(WORD_BITS))
    spell, _ = _mixer(states.get(_STATES[1]), len(BYTE_BITS))
    share = np.clip((ages[:AGES] + 1) / (ages[AGES:] + 20), 1e-4, 0.9)
    share[0] = 0
    return Model(book, table, path, spell, share)


_WORKER: dict[str, dict[int, float]] = {}


def _scorer(key: str, shared):
    """A row for each text, and rows (uid, word, tf) for words that aren't coded, whose counts are joined later."""

    @sparing
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model: Model = shared.value
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = {}
        cache, book = _WORKER[key], model.book
        uid = TaskContext.get().partitionId() << 40
        names = ["uid", "word", "tf", "doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "log_sum", "score"]
        for whole in batches:
            for batch in slices(whole, 2, SLICE):
                if not batch.num_rows:
                    continue
                tokens, rows = Tokens.of(batch.column(2), book), batch.num_rows
                n, place, code, text = len(tokens.words), tokens.place, tokens.code, tokens.text
                spelled, open_at = np.zeros(n), np.flatnonzero(place < 0)
                some = tokens.words.take(pa.array(open_at)).to_pylist()
                value = np.array([cache.get(w, 1.0) for w in some])
                new = np.flatnonzero(value > 0)
                if len(new):
                    names_ = [some[i] for i in new]
                    value[new] = model.spell(names_)
                    if len(cache) + len(new) > CACHE:
                        cache.clear()
                    cache.update(zip(names_[:CACHE], value[new[:CACHE]].tolist(), strict=False))
                spelled[open_at] = value
                logs = np.bincount(text, model.score(tokens, spelled), rows) / math.log(10)
                c = np.append(np.where(place >= 0, book.counts[np.maximum(place, 0)], 0) if len(book.counts) else np.zeros(n, np.int64), book.ends)
                known = np.bincount(text, (c > 0)[code], rows).astype(np.int64)
                base = np.bincount(text, np.log10(c + 1.0)[code], rows)
                ids = uid + np.arange(rows)
                uid += rows
                size = pc.cast(pc.binary_length(batch.column(2)), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.nulls(rows, pa.string()), pa.nulls(rows, pa.int32()), batch.column(0), batch.column(1), size, pa.array(np.bincount(text, minlength=rows)), pa.array(known), pa.array(base), pa.array(logs)], names)
                rare = np.flatnonzero(np.append(place < 0, False)[code])
                pairs = np.sort(text[rare] * max(1, n) + code[rare])
                if len(pairs):
                    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
                    tf = np.diff(np.append(first, len(pairs)))
                    of, word = np.divmod(pairs[first], n)
                    empty = [pa.nulls(len(first), t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[of]), tokens.words.take(pa.array(word)), pa.array(tf, pa.int32()), *empty], names)

    return score


def learn(training: DataFrame, classes: list[int]) -> tuple[DataFrame, int, int, Model]:
    """(words, tokens, distinct, model) of training texts (text, class: a number below len(classes), or -1); classes: texts of each."""
    words = learn_words(training.select("text", "class"))
    totals = words.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    book, least = make_codebook(words, totals["n"] or 0, np.array(classes, float))
    return words, totals["n"] or 0, totals["v"], learn_model(training.select("text"), words, book, least)


def score_texts(docs: DataFrame, held_out, id_col: str = "doc_id", text: str = "text", class_col: str | None = None) -> DataFrame:
    """For each row of docs: the id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte.

    class_col names classes of training texts (a language, say); the CLASSES most frequent are told apart. The scored
    text's own class isn't looked at: its earlier words decide.
    """
    spark = docs.sparkSession
    label = F.col(class_col).cast("string") if class_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), text_or_empty(text).alias("text"), label.alias("label"))
    training = rows.filter(~F.col("held_out"))
    found = training.filter("label is not null").groupBy("label").count().orderBy(F.desc("count"), "label").limit(CLASSES).collect() if class_col else []
    number = F.lit(-1)
    for k, r in enumerate(found):
        number = F.when(F.col("label") == r["label"], k).otherwise(number)
    words, tokens, distinct, model = learn(training.select("text", number.cast("int").alias("class")), [r["count"] for r in found])
    shared = spark.sparkContext.broadcast(model)
    del model
    key = f"{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}"
    schema = "uid long, word string, tf int, doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, log_sum double, score double"
    scored = written(rows.drop("label").mapInArrow(_scorer(key, shared), schema), "lm-scored")
    shared.unpersist()
    # Coded words are the frequent ones; of the others each is rare, so no key of this join is hot.
    rare = words.filter(F.col("word") != END).select("word", "c")
    missed = scored.filter("word is not null").select("uid", "word", "tf").join(rare, "word")
    more = missed.groupBy("uid").agg(F.sum("tf").alias("more_known"), F.sum(F.col("tf") * F.log10(F.col("c") + 1.0)).alias("more_log"))
    texts = scored.filter("word is null").drop("word", "tf").join(more, "uid", "left")
    per_token = math.log10(tokens + distinct + 1)
    log_sum = F.col("log_sum") + F.coalesce("more_log", F.lit(0.0))
    bits = F.when(F.col("n_bytes") > 0, F.col("score") * -math.log2(10) / F.col("n_bytes"))
    return texts.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (log_sum - F.col("n_tokens") * per_token).alias("base_score"), "score", bits.alias("bits_per_byte"),
    )


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    remainder = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 7
    return score_texts(docs, remainder == 2, class_col="lang")
