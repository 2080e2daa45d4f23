"""N-gram Jaccard join by count vectors in R-trees.

Each text is its set of 5-word shingles (64-bit hashes); texts with equal sets are one entity. Shingles are hashed into
GROUPS groups, and an entity's counts of each group are a point; the sum of two points' coordinate minima bounds the
overlap of their sets from above, and so does that of the upper corners of two R-tree nodes for all pairs in them. Long
sets, which so few groups bound badly, are bounded again by finer vectors, whose groups grow with the set.

So that no pair of all entities need be looked at, entities meet in cells: of an order of all shingles (frequent ones
last, then by hash), two sets that are similar enough share one of their first n - ceil(0.8 n) + 1. The entity of a
cell with the least hash is the cell's leader, and cells of one leader are one place: all pairs of a cell
have its leader in common, so each pair is looked at in the place of the least leader they share. Large places are
divided into blocks, and pairs of blocks are tasks of their own. A first R-tree join of a block pair tells which
entities have any partner that the bounds allow; only their texts are gathered, and a second join verifies every pair that is
left, on whole sets, by products of incidence matrices. Pairs never leave a task: it returns a spanning forest of its
links, and each entity's number of them.

Defined results: null and empty texts have no set, n_shingles 0, and are linked with nothing; a text of fewer than five
words is one shingle; rows without an id are linked like others, and a component's id is the least id that isn't
null; a row's links are the other rows whose sets are similar, copies among them; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import forget, released, written
from .components import components
from .shingles import FEW_BYTES, shingle_sets, slices, sparing

#: Similarity in hundredths.
PERCENT = 80
#: Coordinates of a point; entities in a leaf of a tree; leaves that are verified at a time.
GROUPS, LEAF, LEAVES = 256, 32, 8
#: Entities, and bytes of their sets, in a block of a place; numbers in a matrix.
BLOCK, BLOCK_BYTES, MATRIX = 2_048, 16 << 20, 4 << 20
#: A finer vector has a power of two of groups, with no more than so many shingles a group on average.
PER_GROUP = 8
#: A shingle is frequent from one in so many texts on; texts are looked at whole, summaries have so many rows a task.
FREQUENT, TASK_SUMMARY, MOST_FREQUENT = 500, 4_096, 65_536
#: Bits of the filters that tell which texts are needed, and which shingles come in several sets (false positives cost
#: time only).
FILTER_BITS, SHARED_BITS = 1 << 24, 1 << 26


def least_prefix(n: np.ndarray | int):
    """How many first shingles of a set of n must be looked at."""
    return n - (PERCENT * n + 99) // 100 + 1


def least_overlap(n, m):
    """The least intersection of linked sets of n and m shingles."""
    return (PERCENT * (n + m) + 99 + PERCENT) // (100 + PERCENT)


@sparing
def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix shingles that come in many of a task's texts."""
    counts: Counter = Counter()
    for whole in batches:
        for batch in slices(whole, 0):
            firsts = [s[: least_prefix(len(s))] for s in shingle_sets(batch.column(0)) if len(s)]
            if not firsts:
                continue
            keys = np.sort(np.concatenate(firsts))
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            n = np.diff(np.append(starts, len(keys)))
            often = np.flatnonzero(n >= 3)
            often = often[np.argsort(-n[often], kind="stable")][:TASK_SUMMARY]
            counts.update(dict(zip(keys[starts[often]].tolist(), n[often].tolist(), strict=True)))
    best = counts.most_common(TASK_SUMMARY)
    yield pa.RecordBatch.from_arrays([pa.array(np.array([k for k, _ in best], np.uint64).view(np.int64)), pa.array([n for _, n in best], pa.int64())], ["key", "n"])


def frequent_shingles(texts: DataFrame, rows: int) -> np.ndarray:
    """Sorted hashes of MOST_FREQUENT shingles at most; any choice gives the same links, a good one smaller cells."""
    found = texts.mapInArrow(_frequent, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(100, rows // FREQUENT))
    got = [r["key"] for r in found.orderBy(F.desc("n"), "key").limit(MOST_FREQUENT).collect()]
    return np.sort(np.array(got, np.int64).view(np.uint64))


def _is_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _prefix(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    need, take = least_prefix(len(s)), 0
    at = need
    while True:
        often = _is_in(s[:at], frequent)
        take = int((~often).sum())
        if take >= need:
            return s[:at][~often][:need]
        if at >= len(s):
            return np.concatenate([s[~often], s[often]])[:need]
        at = min(len(s), at + max(16, 2 * (need - take)))


def _point(s: np.ndarray, groups: int = GROUPS) -> bytes:
    """Counts by group; all 255 (no bound) where one doesn't fit a byte."""
    counts = np.bincount((s >> np.uint64(17)).astype(np.int64) % groups, minlength=groups)
    return (counts if counts.max() < 255 else np.full(groups, 255)).astype(np.uint8).tobytes()


def _fine(s: np.ndarray) -> bytes | None:
    """Counts by more groups, where a point's are too few for the set."""
    groups = GROUPS
    while len(s) > PER_GROUP * groups:
        groups *= 2
    return _point(s, groups) if groups > GROUPS else None


def set_id(s: np.ndarray) -> int:
    import xxhash

    return int(np.array([xxhash.xxh3_64_intdigest(s.tobytes())], np.uint64).view(np.int64)[0])


def _features(shared):
    @sparing
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for whole in batches:
            for batch in slices(whole, 1, FEW_BYTES):
                sets = shingle_sets(batch.column(1))
                keys = pa.array([_prefix(s, frequent).view(np.int64) if len(s) else None for s in sets], pa.list_(pa.int64()))
                points = pa.array([_point(s) if len(s) else None for s in sets], pa.binary())
                fine = pa.array([_fine(s) if len(s) else None for s in sets], pa.binary())
                ids = pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), ids, keys, points, fine], ["doc_id", "tag", "n", "sid", "keys", "point", "fine"])

    return make


def _tag() -> Column:
    """What a row's text is found by again: the id, or the text's hash where that is null."""
    return F.coalesce("doc_id", F.xxhash64("text"))


def _bit(of: Column, n: int = FILTER_BITS) -> Column:
    return F.pmod(F.xxhash64(of), F.lit(n))


def _filter(bits: DataFrame, n: int) -> bytes:
    """A filter of n bits with those that are in the column bit."""
    words = bits.groupBy(F.shiftright("bit", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits"))
    table, got = np.zeros(n // 64, np.int64), words.toArrow()
    table[got.column("w").to_numpy()] = got.column("bits").to_numpy()
    return table.tobytes()


def _is_set(bits: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _shared_bit(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(17)).astype(np.int64) & (SHARED_BITS - 1)


def _shared(shared):
    """(key, sid) of the first shingles, lists in column keys, whose bits are in the filter."""

    @sparing
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            lists = batch.column(1)
            keys, sid = lists.flatten().to_numpy(), np.repeat(batch.column(0).to_numpy(), pc.list_value_length(lists).to_numpy())
            good = _is_set(bits, _shared_bit(keys.view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(keys[good]), pa.array(sid[good])], ["key", "sid"])

    return make


def _wanted(shared):
    """(sid, text) of the texts whose id's bit is in the filter; a text's bit is in column 1, the text in 2."""

    @sparing
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for whole in batches:
            bit = whole.column(1).to_numpy()
            wanted = whole.filter(pa.array(_is_set(bits, bit)))
            for batch in slices(wanted, 2, FEW_BYTES):
                ids = [set_id(s) if len(s) else None for s in shingle_sets(batch.column(2))]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), batch.column(2)], ["sid", "text"])

    return make


def _folded(vectors: list[bytes], groups: int) -> np.ndarray:
    """Vectors folded to so many groups; those that are no bound stay none."""
    out = np.empty((len(vectors), groups), np.uint32)
    for k, v in enumerate(vectors):
        whole = np.frombuffer(v, np.uint8)
        out[k] = whole.reshape(-1, groups).sum(0, dtype=np.uint32) if whole[0] < 255 else 1 << 30
    return out


def _finely_allowed(fine: list[bytes | None], n: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the pairs (x, y) the summed minima of finer vectors allow, compared at the coarser one's groups."""
    size = np.array([len(v) if v is not None else 0 for v in fine])
    groups, good = np.minimum(size[x], size[y]), np.ones(len(x), bool)
    for g in np.unique(groups[groups > 0]).tolist():
        rows = np.flatnonzero(groups == g)
        wide = int(max(size[x[rows]].max(), size[y[rows]].max()))
        for at in range(0, len(rows), max(1, (1 << 22) // wide)):
            some = rows[at : at + max(1, (1 << 22) // wide)]
            used, place = np.unique(np.concatenate([x[some], y[some]]), return_inverse=True)
            folded = _folded([fine[k] for k in used], g)
            left, right = folded[place[: len(some)]], folded[place[len(some) :]]
            good[some] = np.minimum(left, right).sum(1, dtype=np.int64) >= least_overlap(n[x[some]], n[y[some]])
    return good


class RTree:
    """A packed R-tree over points: entities in order of size, then of the heaviest coordinates, in leaves of LEAF."""

    def __init__(self, points: np.ndarray, n: np.ndarray):
        varied = np.argsort(-points.astype(np.float32).var(0))[:2] if len(points) > 1 else [0, 0]
        self.order = np.lexsort((points[:, varied[1]], points[:, varied[0]], n))
        self.points, self.n = points[self.order], n[self.order]
        # Levels from leaves up: upper corner, least and greatest size of each node.
        starts = np.arange(0, len(n), LEAF)
        self.levels = [(np.maximum.reduceat(self.points, starts), np.minimum.reduceat(self.n, starts), np.maximum.reduceat(self.n, starts))]
        while len(self.levels[-1][0]) > LEAF:
            corner, low, high = self.levels[-1]
            starts = np.arange(0, len(corner), LEAF)
            self.levels.append((np.maximum.reduceat(corner, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))

    def leaves(self, other: "RTree") -> list[tuple[int, int]]:
        """Pairs of leaves whose corners allow a link; those of a tree with itself come once."""
        depth = min(len(self.levels), len(other.levels)) - 1
        a, b = self.levels[depth], other.levels[depth]
        pairs = [(i, j) for i in range(len(a[1])) for j in range(len(b[1])) if self is not other or i <= j]
        for level in range(depth, -1, -1):
            a, b = self.levels[level], other.levels[level]
            pairs = self._allowed(a, b, pairs)
            if level:
                below, over = len(self.levels[level - 1][1]), len(other.levels[level - 1][1])
                pairs = [(i, j) for x, y in pairs for i in range(x * LEAF, min((x + 1) * LEAF, below)) for j in range(y * LEAF, min((y + 1) * LEAF, over)) if self is not other or i <= j]
        return pairs

    def join(self, other: "RTree") -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places in the two inputs whose bound allows a link, from leaf to leaf."""
        for x, y in self.leaves(other):
            p, q = slice(x * LEAF, (x + 1) * LEAF), slice(y * LEAF, (y + 1) * LEAF)
            n, m = self.n[p][:, None], other.n[q][None, :]
            P, Q = self.points[p], other.points[q]
            fits = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
            if not fits.any():
                continue
            i, j = np.nonzero(fits)
            bound = np.minimum(P[i], Q[j]).sum(1, dtype=np.int64)
            good = (bound >= least_overlap(n[i, 0], m[0, j])) | (P[i, 0] == 255) | (Q[j, 0] == 255)
            if good.any():
                yield self.order[p][i[good]], other.order[q][j[good]]

    @staticmethod
    def _allowed(a, b, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        if not pairs:
            return []
        i, j = np.array(pairs).T
        # Sizes of the two nodes must come within the ratio; the corners' minima must reach the least overlap of the smallest.
        ok = (100 * a[2][i] >= PERCENT * b[1][j]) & (100 * b[2][j] >= PERCENT * a[1][i])
        i, j = i[ok], j[ok]
        out = []
        for at in range(0, len(i), 4096):
            x, y = i[at : at + 4096], j[at : at + 4096]
            bound = np.minimum(a[0][x], b[0][y]).sum(1, dtype=np.int64)
            least = np.maximum(a[1][x], (PERCENT * b[1][y] + 99) // 100)
            need = np.minimum(least_overlap(a[1][x], b[1][y]), least)
            good = (bound >= need) | (a[0][x].max(1) == 255) | (b[0][y].max(1) == 255)
            out += list(zip(x[good].tolist(), y[good].tolist(), strict=True))
        return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by (leader, i, j) as tables of whole groups, with where each begins, and the end."""

    def starts(table: pa.Table) -> np.ndarray:
        of = np.stack([table.column(c).to_numpy() for c in ("leader", "i", "j")])
        return np.flatnonzero(np.concatenate([[True], (of[:, 1:] != of[:, :-1]).any(0)]))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        at = starts(table)
        if at[-1]:
            yield table.slice(0, int(at[-1])).combine_chunks(), at
            held = table.slice(int(at[-1])).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, np.append(starts(table), table.num_rows)


def _points(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("point").to_pylist()), np.uint8).reshape(-1, GROUPS)


@sparing
def _hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows of each block pair those that have a partner in it by the R-trees' bounds, without their vectors.

    Pairs that share a lesser leader are looked at in that one's place.
    """
    for table, at in _groups(batches):
        sizes = np.diff(at)
        good = np.zeros(table.num_rows, bool)
        side, n = table.column("side").to_numpy(), table.column("n").to_numpy()
        fine = table.column("fine").to_pylist()
        lists, leader = table.column("leaders").combine_chunks(), table.column("leader").to_numpy()
        small = np.repeat(sizes <= LEAF, sizes)
        rows = np.flatnonzero(small)
        if len(rows):
            group = np.repeat(np.arange(len(sizes)), sizes)[rows]
            x, y = _near(group, side[rows], n[rows], _points(table.filter(pa.array(small))))
            x, y = rows[x], rows[y]
            each = {k: {v for v in lists[k].as_py() if v < leader[k]} for k in np.unique(np.concatenate([x, y])).tolist()}
            here = np.array([each[p].isdisjoint(each[q]) for p, q in zip(x.tolist(), y.tolist(), strict=True)], bool)
            x, y = x[here], y[here]
            ok = _finely_allowed(fine, n, x, y)
            good[x[ok]] = good[y[ok]] = True
        for start, stop in zip(at[:-1], at[1:], strict=True):
            if stop - start <= LEAF:
                continue
            points = _points(table.slice(int(start), int(stop - start)))
            left, right = (np.flatnonzero(w) + start for w in (side[start:stop] <= 0, side[start:stop] >= 0))
            a = RTree(points[left - start], n[left])
            b = a if side[start] == 0 else RTree(points[right - start], n[right])
            each, row = _lesser(lists, int(start), int(stop), leader[start])
            elsewhere = _meet(each, row, left, right) if len(each) else None
            for x, y in a.join(b):
                here = left[x] != right[y]
                if elsewhere is not None:
                    here &= ~elsewhere[x, y]
                x, y = left[x[here]], right[y[here]]
                ok = _finely_allowed(fine, n, x, y)
                good[x[ok]] = good[y[ok]] = True
        out = table.filter(pa.array(good)).drop_columns(["point", "fine"])
        yield from out.to_batches()


def _near(group: np.ndarray, side: np.ndarray, n: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that the bounds allow in groups of one leaf, all groups at once: places that are 1, 2, ... apart."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for apart in range(1, LEAF):
        ok = group[apart:] == group[:-apart]
        if not ok.any():
            break
        ok &= 100 * np.minimum(n[apart:], n[:-apart]) >= PERCENT * np.maximum(n[apart:], n[:-apart])
        ok &= (side[apart:] == 0) | (side[apart:] != side[:-apart])
        i = np.flatnonzero(ok)
        for k in range(0, len(i), 8192):
            x = i[k : k + 8192]
            y = x + apart
            good = (np.minimum(points[x], points[y]).sum(1, dtype=np.int64) >= least_overlap(n[x], n[y])) | (points[x, 0] == 255) | (points[y, 0] == 255)
            left.append(x[good])
            right.append(y[good])
    return np.concatenate(left), np.concatenate(right)


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each of some sorted sets has in common with each of some others."""
    out = np.zeros((len(left), len(right)), np.int64)
    mine, theirs = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(mine, theirs)
    if not len(both):
        return out
    ends = []
    for values, sets in ((mine, left), (theirs, right)):
        column = np.minimum(np.searchsorted(both, values), len(both) - 1)
        hit = both[column] == values
        row, column = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[hit], column[hit]
        order = np.argsort(column, kind="stable")
        ends.append((row[order], column[order]))
    (r, c), (s, d) = ends
    width = max(64, MATRIX // (len(left) + len(right)))
    for first in range(0, len(both), width):
        some = min(width, len(both) - first)
        x, y = np.zeros((len(left), some), np.float32), np.zeros((len(right), some), np.float32)
        p, q = slice(*np.searchsorted(c, (first, first + some))), slice(*np.searchsorted(d, (first, first + some)))
        x[r[p], c[p] - first] = 1
        y[s[q], d[q] - first] = 1
        out += (x @ y.T).astype(np.int64)
    return out


@sparing
def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, null) for a spanning forest of each block pair's links, and (a, null, n): a has n links to rows there.

    Pairs that share a lesser leader are counted in that one's place.
    """
    for table, at in _groups(batches):
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        counts = np.zeros(table.num_rows, np.int64)
        sid, n, copies, side, leader = (table.column(c).to_numpy() for c in ("sid", "n", "copies", "side", "leader"))
        sets = [s for part in slices(table.select(["text"]).to_batches()[0], 0, FEW_BYTES) for s in shingle_sets(part.column(0))]
        leaders = table.column("leaders").combine_chunks()
        for start, stop in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if stop - start > 1:
                ends += _block(start, stop, sets, n, copies, side, leader[start], leaders, counts)
        a = np.concatenate([x for x, _ in ends]) if ends else np.zeros(0, np.int64)
        b = np.concatenate([y for _, y in ends]) if ends else np.zeros(0, np.int64)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([sid[a], sid[some]])), pa.concat_arrays([pa.array(sid[b]), pa.nulls(len(some), pa.int64())]), pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(counts[some])]),
        ], ["a", "b", "n"])


def _block(start: int, stop: int, sets: list[np.ndarray], n: np.ndarray, copies: np.ndarray, side: np.ndarray, leader: int, leaders: pa.Array, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of one block pair, the rows from start to stop: adds to counts, and returns the ends of a spanning forest."""
    own = side[start] == 0
    left, right = (np.flatnonzero(w) + start for w in (side[start:stop] <= 0, side[start:stop] >= 0))
    if not len(left) or not len(right):
        return []
    made = {k: np.frombuffer(_point(sets[k]), np.uint8) for k in range(start, stop)}
    a = RTree(np.stack([made[k] for k in left]), n[left])
    b = a if own else RTree(np.stack([made[k] for k in right]), n[right])
    left, right = left[a.order], right[b.order]
    each, row = _lesser(leaders, start, stop, leader)
    partners: dict[int, set[int]] = {}
    for x, y in a.leaves(b):
        partners.setdefault(x // LEAVES, set()).add(y)
    label, out = np.arange(stop - start), []
    for chunk, found in sorted(partners.items()):
        x = np.arange(chunk * LEAVES * LEAF, min((chunk + 1) * LEAVES * LEAF, len(left)))
        y = (np.array(sorted(found))[:, None] * LEAF + np.arange(LEAF)).ravel()
        y = y[y < len(right)]
        i, j = left[x], right[y]
        common = intersections([sets[k] for k in i], [sets[k] for k in j])
        linked = 100 * common >= PERCENT * (n[i][:, None] + n[j][None, :] - common)
        if own:
            linked &= x[:, None] < y[None, :]
        if not linked.any():
            continue
        if len(each):
            once = linked & ~_meet(each, row, i, j)
        else:
            once = linked
        counts[i] += once @ copies[j]
        counts[j] += once.T @ copies[i]
        for k in np.flatnonzero(linked.any(1)):
            to = j[linked[k]]
            labels, first = np.unique(label[to - start], return_index=True)
            new = labels != label[i[k] - start]
            if new.any():
                out.append((np.full(int(new.sum()), i[k]), to[first[new]]))
                label[np.isin(label, labels[new])] = label[i[k] - start]
    return out


def _lesser(leaders: pa.Array, start: int, stop: int, leader: int) -> tuple[np.ndarray, np.ndarray]:
    """The leaders below this one that the rows from start to stop have, and whose they are."""
    lists = leaders.slice(start, stop - start)
    each, row = lists.flatten().to_numpy(), np.repeat(np.arange(start, stop), pc.list_value_length(lists).to_numpy())
    return each[each < leader], row[each < leader]


def _meet(each: np.ndarray, row: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j have one of the leaders (each, of row) in common."""
    of = [np.flatnonzero(np.isin(row, x)) for x in (i, j)]
    both = np.intersect1d(each[of[0]], each[of[1]])
    out = np.zeros((len(i), len(j)), bool)
    if not len(both):
        return out
    width = max(64, MATRIX // (len(i) + len(j)))
    for first in range(0, len(both), width):
        some, halves = both[first : first + width], []
        for at, rows in zip(of, (i, j), strict=True):
            order = np.argsort(rows)
            column = np.minimum(np.searchsorted(some, each[at]), len(some) - 1)
            hit = some[column] == each[at]
            m = np.zeros((len(rows), len(some)), np.float32)
            m[order[np.searchsorted(rows[order], row[at][hit])], column[hit]] = 1
            halves.append(m)
        out |= halves[0] @ halves[1].T > 0
    return out


class Join:
    """The join's tables: entities (sid, rep, tag, n, copies, point, fine), rows (doc_id, n, sid), and places (leader, sid)."""

    def __init__(self, docs: DataFrame, id_col: str, text: str):
        self.spark = docs.sparkSession
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
        sc = self.spark.sparkContext
        frequent = frequent_shingles(self.docs.select("text"), self.docs.count())
        tagged = self.docs.select("doc_id", "text", _tag().alias("tag"))
        features = written(tagged.mapInArrow(_features(sc.broadcast(frequent)), "doc_id long, tag long, n long, sid long, keys array<long>, point binary, fine binary"), "jaccard-features")
        # Copies are reduced to one entity before anything is exchanged.
        firsts = features.filter("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("rep"), F.min("tag").alias("tag"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys"), F.first("point").alias("point"), F.first("fine").alias("fine"))
        full = written(firsts, "jaccard-full")
        self.rows = written(features.select("doc_id", "n", "sid"), "jaccard-rows")
        self.entities = written(full.select("sid", "rep", "tag", "n", "copies", "point", "fine"), "jaccard-entities")
        forget(features)
        self.places = self._places(full.select("sid", "keys"))
        forget(full)
        released(self.spark)

    def _places(self, first: DataFrame) -> DataFrame:
        """(leader, sid): what entities meet in, from the cells (key, sid) that hold more than one; first: (sid, keys)."""
        # Few first shingles are in more than one set: the others are left out, by a filter, before sets go with them.
        several = first.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        bits = several.select(F.shiftright("key", 17).bitwiseAND(F.lit(SHARED_BITS - 1)).alias("bit"))
        keep = self.spark.sparkContext.broadcast(_filter(bits, SHARED_BITS))
        rows = written(first.mapInArrow(_shared(keep), "key long, sid long"), "jaccard-shared")
        released(self.spark)
        cells = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("sid").alias("leader")).filter("size > 1")
        out = written(rows.join(cells.select("key", "leader"), "key").select("leader", "sid").distinct(), "jaccard-places")
        forget(rows)
        return out

    def block_pairs(self) -> DataFrame:
        """(leader, i, j, side, sid, n, copies, leaders): each place's rows in pairs of its blocks, i <= j.

        An entity's leaders are no more than its first shingles. Rows are copied once for each block of their place.
        """
        n = self.places.join(self.entities.select("sid", "n", "copies"), "sid")
        leaders = n.groupBy("sid", "n", "copies").agg(F.sort_array(F.collect_set("leader")).alias("leaders"))
        rows = written(leaders.select("sid", "n", "copies", "leaders", F.explode("leaders").alias("leader")), "jaccard-met")
        blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("int")
        large = rows.groupBy("leader").agg(blocks.alias("blocks"))
        own = rows.join(large, "leader").withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
        other = own.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        side = F.when(F.col("own") == F.col("o"), 0).when(F.col("own") < F.col("o"), -1).otherwise(1)
        return other.select("leader", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), side.alias("side"), "sid", "n", "copies", "leaders")

    def _texts_of(self, sids: DataFrame) -> DataFrame:
        """(sid, text) of the entities in sids, and perhaps some others, once each."""
        tags = sids.join(self.entities.select("sid", "tag"), "sid").select(_bit(F.col("tag")).alias("bit"))
        source = self.docs.select("doc_id", _bit(_tag()).alias("bit"), "text")
        made = source.mapInArrow(_wanted(self.spark.sparkContext.broadcast(_filter(tags, FILTER_BITS))), "sid long, text string")
        return made.filter("sid is not null").groupBy("sid").agg(F.first("text").alias("text"))

    def links(self) -> DataFrame:
        """(a, b, null): links that connect all components, and (a, null, n): what has to be summed to each entity's number."""
        order = ["leader", "i", "j"]
        pairs = self.block_pairs().join(self.entities.select("sid", "point", "fine"), "sid").repartition(*order).sortWithinPartitions(*order)
        hopeful = "leader long, i int, j int, side int, n long, copies long, sid long, leaders array<long>"
        names = [x.split()[0] for x in hopeful.split(", ")]
        left = written(pairs.select(*names, "point", "fine").mapInArrow(_hopeful, hopeful), "jaccard-hopeful")
        texts = self._texts_of(left.select("sid").distinct())
        whole = left.join(texts, "sid").select(*names, "text").repartition(*order).sortWithinPartitions(*order)
        out = written(whole.mapInArrow(_verified, "a long, b long, n long"), "jaccard-links")
        forget(left)
        released(self.spark)
        return out

    def members(self) -> DataFrame:
        """(doc_id, n_shingles, component_id, n_links) of every row."""
        links = self.links()
        roots = written(components(links.filter("b is not null").select("a", "b")), "jaccard-roots")
        others = links.filter("b is null").groupBy("a").agg(F.sum("n").alias("others"))
        entity = self.entities.select("sid", "rep", "copies")
        rooted = entity.join(roots, entity["sid"] == roots["node"], "left").select("sid", "rep", "copies", F.coalesce("root", "sid").alias("root"))
        least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
        n = F.col("copies") - 1 + F.coalesce("others", F.lit(0))
        table = rooted.join(least, "root").join(others, F.col("sid") == others["a"], "left")
        table = written(table.select(F.col("sid").alias("s"), "component_id", n.cast("long").alias("n_links")), "jaccard-table")
        rows = self.rows.select("doc_id", F.col("n").alias("n_shingles"), "sid")
        out = rows.join(table, rows["sid"] == table["s"], "left")
        return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def similar(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row of docs."""
    return Join(docs, id_col, text).members()


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(spark.read.parquet(f"{sf_dir}/documents.parquet"))
