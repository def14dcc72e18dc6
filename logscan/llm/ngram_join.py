"""Operator 8: n-gram Jaccard self-join with a count-vector R-tree.

A document is its set of distinct 5-word shingles.  Documents with equal sets
form one class, which takes part once.  Two sets of sizes a and b link when
their overlap is at least 4 (a + b) / 9, that is a Jaccard similarity of 0.8.

* Co-location: in any one order of all shingles, linked sets share one of
  their first n - ceil(0.8 n) + 1, so classes meet under those keys.  The
  order is by hash, but shingles found to be common (``heavy_shingles``: those
  repeated within parts of the corpus, a table of bounded size) come last and
  the commonest of them at the very end: passages that many documents share
  then key few of them.  The table only shapes the groups, never the links.
  Keys of one class, and classes without a partner of similar size, drop out.  Two
  classes that met under the key before need not meet again, so a key all of
  whose classes share the key before drops out too.  A hot key is split into
  pairs of blocks, so no task holds it whole.
* Index: under a key, every class is a point: its shingles hashed into 64
  groups (more for long texts), counted.  Points are packed by size into the
  leaves of an R-tree.  The overlap of two sets is at most the sum of the
  smaller counts, group by group; over two boxes, of the smaller box maxima.
  The tree is joined with itself, descending only where that bound allows a link.
* Verification: surviving pairs are checked by the same bound over finer
  counts (about as many groups as shingles), then on their whole shingle sets.

The first pass verifies few pairs: of small groups a spanning forest of the
best bounds, of large ones (thousands of near copies) each point's best
partner.  Once those links have made components, a second pass drops the
groups that lie in one component and checks, on wider points, every remaining
pair of points in different components that the bound allows.  So no link
between different components is lost, and pairs inside a component are never
enumerated.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscan.llm.common import (POSITIVE, SPACE_WORDS, Scratch, hashed_words, read_table, released, row_hash,
                                text_slices, windows)
from logscan.llm.components import components
from logscan.session import ship_package

SHINGLE = 5
GROUPS = 64          # groups of a point; long texts have up to MAX_GROUPS, folded to 64 in the tree
MAX_GROUPS = 1024
LEAF = 32            # points per leaf; groups up to this size are one leaf
FANOUT = 16
CHUNK_ROWS = 50_000
HOT_SAMPLE = 64      # 1 in so many classes is looked at to find hot keys (load balance only)
HOT_KEYS = 1024      # at most so many keys are split: bounds the broadcast
BLOCK_ROWS = 4096    # rows per block of a hot key
HEAVY_MAX = 1 << 18  # common shingles that go last (16 bytes each, broadcast)
HEAVY_PART = 1 << 22  # shingles looked at together when common ones are counted
HEAVY_MIN = 4        # texts of such a part that must hold a shingle
FINE_MAX = 1 << 14   # groups of the finer counts at most
POINT_CELLS = 1 << 20  # counts of points that are compared at once
FILTER_BITS = 1 << 26  # of an id filter (8 MB, broadcast)
_MANY = 1 << 24      # stands for a count that did not fit its byte


def shingle_sets(texts: pa.Array):
    """Sorted distinct 64-bit shingle hashes of each text, in order."""
    for _, data, offsets in text_slices(texts):
        words = hashed_words(data, offsets, SPACE_WORDS)
        bounds = words.bounds()
        grams = windows(words.hash, SHINGLE)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if hi - lo >= SHINGLE:
                yield np.unique(grams[lo:hi - SHINGLE + 1])
            else:
                yield windows(words.hash[lo:hi], hi - lo) if hi > lo else np.zeros(0, dtype=np.uint64)


def prefix_length(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1 if n else 0


def prefix_keys(s: np.ndarray, heavy: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a set: light ones by hash, then heavy ones by
    falling rarity.  ``heavy`` is sorted; ``rank`` orders it, rarest first."""
    k = prefix_length(len(s))
    if not len(heavy) or not k:
        return s[:k]
    at = np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)
    common = heavy[at] == s
    light = s[~common]
    if len(light) >= k:
        return light[:k]
    late = s[common][np.argsort(rank[at[common]])]
    return np.concatenate([light, late[:k - len(light)]])


def _repeated(batches):
    """(shingle, texts) of shingles that several texts of a part of the
    partition hold; equal texts of a part count once."""
    held, size, seen = np.empty(HEAVY_PART, dtype=np.uint64), 0, set()

    def counted(part):
        part.sort()  # in place: a part is the only large array here
        k = max(0, len(part) - HEAVY_MIN + 1)
        values = np.unique(part[:k][part[len(part) - k:] == part[:k]])
        n = np.searchsorted(part, values, side="right") - np.searchsorted(part, values)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], ["shingle", "texts"])

    for batch in batches:
        for s in shingle_sets(batch.column("text")):
            mark = hash(s.tobytes())
            if len(s) and mark not in seen:
                seen.add(mark)
                if size + len(s) > len(held):  # the last text of a part
                    held = np.concatenate([held[:size], s])
                else:
                    held[size:size + len(s)] = s
                size += len(s)
            if size >= HEAVY_PART:
                yield counted(held[:size])
                held, size, seen = held[:HEAVY_PART], 0, set()
    if size:
        yield counted(held[:size])


def heavy_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingles, rank) of the commonest repeated shingles, at most
    ``HEAVY_MAX`` (a bounded transfer to the driver)."""
    rows = (texts.select("text").mapInArrow(released(_repeated), "shingle long, texts long").groupBy("shingle")
            .agg(F.sum("texts").alias("texts")).orderBy(F.desc("texts"), "shingle").limit(HEAVY_MAX).toArrow())
    shingles = rows.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], np.arange(len(shingles), 0, -1)[order]


def _counts(s: np.ndarray, groups: int) -> bytes:
    """Shingles per group, one byte each (255: or more)."""
    c = np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return np.minimum(c, 255).astype(np.uint8).tobytes()


def _power(n: float, low: int, high: int) -> int:
    return min(high, max(low, 1 << max(0, int(np.ceil(np.log2(max(n, 1)))))))


def count_vector(s: np.ndarray) -> bytes:
    """The point that travels with every key of the first pass."""
    return _counts(s, _power(len(s) / 4, GROUPS, MAX_GROUPS))


def wide_vector(s: np.ndarray) -> bytes:
    """The point of the second pass."""
    return _counts(s, _power(len(s), GROUPS, MAX_GROUPS))


def fine_counts(s: np.ndarray) -> bytes | None:
    """Counts over about as many groups as shingles; None: the wide vector has them."""
    return _counts(s, _power(len(s), GROUPS, FINE_MAX)) if len(s) > MAX_GROUPS else None


def _folded(rows: list[bytes], groups: int) -> np.ndarray:
    """Count vectors of one or more widths, summed down to ``groups`` columns."""
    out = np.empty((len(rows), groups), dtype=np.int32)
    lengths = np.array([len(r) for r in rows])
    for width in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == width)
        c = np.frombuffer(b"".join([rows[i] for i in at]), dtype=np.uint8).reshape(len(at), -1, groups).astype(np.int32)
        c[c == 255] = _MANY
        out[at] = np.minimum(c.sum(axis=1), _MANY)
    return out


def fine_bound(a: bytes, b: bytes) -> int:
    """Upper bound of the overlap of two sets from their finer counts."""
    x, y = _folded([a, b], min(len(a), len(b)))
    return int(_bound(x, y))


def _describe(heavy):
    """_id, doc_id, text -> _id, doc_id, set size, fingerprint, prefix keys, count vectors."""
    return lambda batches: _described(batches, *heavy.value)


def _described(batches, heavy: np.ndarray, rank: np.ndarray):
    for batch in batches:
        n, h1, h2, keys, vecs, wide, fine = [], [], [], [], [], [], []
        for s in shingle_sets(batch.column("text")):
            digest = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), dtype=np.int64)
            n.append(len(s))
            h1.append(int(digest[0]))
            h2.append(int(digest[1]))
            keys.append(prefix_keys(s, heavy, rank).view(np.int64))
            vecs.append(count_vector(s))
            wide.append(wide_vector(s))
            fine.append(fine_counts(s))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("doc_id"), pa.array(n, type=pa.int32()), pa.array(h1, type=pa.int64()),
             pa.array(h2, type=pa.int64()), pa.array(keys, type=pa.list_(pa.int64())), pa.array(vecs, type=pa.binary()),
             pa.array(wide, type=pa.binary()), pa.array(fine, type=pa.binary())],
            ["_id", "doc_id", "n", "h1", "h2", "keys", "vec", "wide", "fine"])


# ------------------------------------------------------------ filters of ids
def _place(id_col: str) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(FILTER_BITS))


def _bits(ids: DataFrame) -> np.ndarray:
    """A bit set for the place of every ``_id`` of ``ids``.  Rows that have
    theirs unset are not among them; of a wide table only the others (and
    those that share a place by chance) then go on."""
    words = (ids.select(_place("_id").alias("p")).groupBy(F.shiftright("p", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("bits")).toArrow())
    bits = np.zeros(FILTER_BITS >> 6, dtype=np.int64)
    bits[words.column("w").to_numpy()] = words.column("bits").to_numpy()
    return bits


def _passes(bits: np.ndarray, place: pa.Array) -> pa.Array:
    p = place.to_numpy()
    return pa.array((bits[p >> 6] >> (p & 63)) & 1 == 1)


def _filtered(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``_id`` is among ``ids``, and few others."""
    bits = rows.sparkSession.sparkContext.broadcast(_bits(ids))

    @F.arrow_udf(T.BooleanType())
    def among(place: pa.Array) -> pa.Array:
        return _passes(bits.value, place)

    return rows.where(among(_place("_id")))


def _sets_of(bits):
    """Shingle sets of the rows that pass the filter; no text leaves its task."""
    def run(batches):
        for batch in batches:
            batch = batch.filter(_passes(bits.value, batch.column("place")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array([s.tobytes() for s in shingle_sets(batch.column("text"))], type=pa.binary())],
                ["id", "set"])

    return run


# ------------------------------------------------------------ groups of rows
def _grouped(batches, keys, chunk_rows: int = CHUNK_ROWS):
    """Record batches of a sorted partition -> tables that end at group borders."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < chunk_rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        first = _group_starts(table, keys)[-1]
        if first:
            yield table.slice(0, first)
            held = table.slice(first).to_batches()
            rows = table.num_rows - int(first)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _group_starts(table: pa.Table, keys) -> np.ndarray:
    change = np.ones(table.num_rows, dtype=bool)
    change[1:] = False
    for k in keys:
        v = table.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)


def _shared_rows(batches):
    """Rows whose key some class of similar size shares.  Sorted by key,
    block pair and size."""
    keys = ("key", "s", "t")
    for table in _grouped(batches, keys):
        starts = _group_starts(table, keys)
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
        n = table.column("n").to_numpy().astype(np.int64)
        near = (group[1:] == group[:-1]) & (5 * n[:-1] >= 4 * n[1:])
        keep = np.zeros(len(n), dtype=bool)
        keep[1:] |= near
        keep[:-1] |= near
        at = np.flatnonzero(keep)
        if len(at):
            yield from table.take(pa.array(at)).to_batches()


def _new_groups(batches):
    """Drops groups all of whose rows share the key before: each of their
    pairs meets there."""
    keys = ("key", "s", "t")
    for table in _grouped(batches, keys):
        starts = _group_starts(table, keys)
        sizes = np.diff(np.append(starts, table.num_rows))
        prev, key = table.column("prev").to_numpy(), table.column("key").to_numpy()
        head = np.repeat(prev[starts], sizes)
        mixed = np.maximum.reduceat((prev != head) | (prev == key), starts)
        at = np.flatnonzero(np.repeat(mixed, sizes))
        if len(at):
            yield from table.take(pa.array(at)).to_batches()


def _mixed_groups(batches):
    """Drops groups that lie in one component."""
    keys = ("key", "s", "t")
    for table in _grouped(batches, keys):
        starts = _group_starts(table, keys)
        sizes = np.diff(np.append(starts, table.num_rows))
        comp = table.column("comp").to_numpy()
        mixed = np.logical_or.reduceat(comp != np.repeat(comp[starts], sizes), starts)
        at = np.flatnonzero(np.repeat(mixed, sizes))
        if len(at):
            yield from table.take(pa.array(at)).to_batches()


def spanning_forest(a: np.ndarray, b: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Numbers of the pairs (a, b) of a forest that joins what all pairs
    join, by highest scores: in each round every tree takes its best pair to
    another one."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[:len(a)], ends[len(a):]
    order = np.lexsort((b, a, -score))
    rank = np.empty(len(a), dtype=np.int64)
    rank[order] = np.arange(len(a))
    tree, kept, live = np.arange(len(nodes)), np.zeros(len(a), dtype=bool), np.arange(len(a))
    while True:
        live = live[tree[u[live]] != tree[v[live]]]
        if not len(live):
            return np.flatnonzero(kept)
        best = np.full(len(nodes), len(a))
        np.minimum.at(best, tree[u[live]], rank[live])
        np.minimum.at(best, tree[v[live]], rank[live])
        own = np.flatnonzero(best < len(a))
        edge = order[best[own]]
        kept[edge] = True
        to = np.arange(len(nodes))
        to[own] = tree[u[edge]] + tree[v[edge]] - own
        mutual = own[(to[to[own]] == own) & (own < to[own])]
        to[mutual] = mutual
        while (to[to] != to).any():
            to = to[to]
        tree = to[tree]


def _bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of coordinate minima along the last axis."""
    return np.minimum(a, b).sum(axis=-1, dtype=np.int64)


class RTree:
    """Two levels of boxes over count vectors sorted by set size: a box holds
    the largest count per group and the range of sizes below it."""

    def __init__(self, n: np.ndarray, vec: np.ndarray):
        self.n, self.vec = n, vec
        self.order = self._pack(n, vec)
        self.leaves = [self.order[i:i + LEAF] for i in range(0, len(n), LEAF)]
        self.leaf_box = self._boxes(self.leaves, vec, n)
        self.nodes = [np.arange(i, min(i + FANOUT, len(self.leaves))) for i in range(0, len(self.leaves), FANOUT)]
        self.node_box = self._boxes(self.nodes, self.leaf_box[0], self.leaf_box[1], self.leaf_box[2])

    @staticmethod
    def _pack(n, vec):
        """Slices by size, inside a slice leaves by the most varying group."""
        order = np.argsort(n, kind="stable")
        out = []
        for i in range(0, len(order), LEAF * FANOUT):
            part = order[i:i + LEAF * FANOUT]
            spread = vec[part].astype(np.float64).var(axis=0)
            out.append(part[np.argsort(vec[part, int(np.argmax(spread))], kind="stable")])
        return np.concatenate(out)

    @staticmethod
    def _boxes(parts, vec, lo, hi=None):
        hi = lo if hi is None else hi
        return (np.stack([vec[p].max(axis=0) for p in parts]), np.array([lo[p].min() for p in parts]),
                np.array([hi[p].max() for p in parts]))

    @staticmethod
    def _meet(box, i, j):
        """Whether pairs of boxes (i, j) may hold linked points."""
        top, lo, hi = box
        ok = (5 * hi[i] >= 4 * lo[j]) & (5 * hi[j] >= 4 * lo[i])
        ok[ok] = 9 * _bound(top[i[ok]], top[j[ok]]) >= 4 * (lo[i[ok]] + lo[j[ok]])
        return ok

    def pairs(self):
        """Blocks of (i, j, bound) point numbers that the bound lets pass, i != j."""
        a, b = np.triu_indices(len(self.nodes))
        ok = self._meet(self.node_box, a, b)
        for x, y in zip(a[ok].tolist(), b[ok].tolist()):
            la, lb = (g.ravel() for g in np.meshgrid(self.nodes[x], self.nodes[y], indexing="ij"))
            if x == y:
                la, lb = la[la <= lb], lb[la <= lb]
            hit = self._meet(self.leaf_box, la, lb)
            for i, j in zip(la[hit].tolist(), lb[hit].tolist()):
                p, q = self.leaves[i], self.leaves[j]
                total = _bound(self.vec[p][:, None, :], self.vec[q][None, :, :])
                np_, nq = self.n[p][:, None], self.n[q][None, :]
                good = (9 * total >= 4 * (np_ + nq)) & (5 * np_ >= 4 * nq) & (5 * nq >= 4 * np_)
                if i == j:
                    good &= np.triu(np.ones_like(good), 1)
                r, c = np.nonzero(good)
                if len(r):
                    yield p[r], q[c], total[r, c]


def _small_pairs(group, n, vec):
    """All pairs the bound lets pass in groups of at most LEAF rows, every
    group at once: row i against row i + d of the same group."""
    out = []
    for d in range(1, LEAF):
        i = np.flatnonzero(group[d:] == group[:-d])
        if not len(i):
            break
        j = i + d
        near = 5 * n[i] >= 4 * n[j]
        i, j = i[near], j[near]
        ok = 9 * _bound(vec[i], vec[j]) >= 4 * (n[i] + n[j])
        out.append((i[ok], j[ok]))
    return out


class _Wide:
    """The points of one group at their full widths: a pair is bounded again
    over as many groups as its narrower point has."""

    def __init__(self, raw: list[bytes], n: np.ndarray):
        self.n = n
        self.width = np.array([len(r) for r in raw])
        self.at, self.points = {}, {}
        for w in np.unique(self.width).tolist():
            if w > GROUPS:
                rows = np.flatnonzero(self.width >= w)
                self.at[w] = np.full(len(raw), -1)
                self.at[w][rows] = np.arange(len(rows))
                self.points[w] = _folded([raw[r] for r in rows], w)

    def passing(self, i, j, total=None):
        """The pairs that still may link, with their bounds; ``total`` holds
        the bounds over 64 groups of pairs known to pass there."""
        total = self.n[i] + self.n[j] if total is None else total.copy()
        narrow = np.minimum(self.width[i], self.width[j])
        for w, points in self.points.items():
            at = np.flatnonzero(narrow == w)
            for k in range(0, len(at), POINT_CELLS // w):
                part = at[k:k + POINT_CELLS // w]
                total[part] = _bound(points[self.at[w][i[part]]], points[self.at[w][j[part]]])
        ok = 9 * total >= 4 * (self.n[i] + self.n[j])
        return i[ok], j[ok], total[ok]


def _candidates(second: bool):
    """Candidate pairs (a < b) of a partition sorted by key, block pair, size."""
    keys = ("key", "s", "t")

    def run(batches):
        for table in _grouped(batches, keys):
            starts = _group_starts(table, keys)
            sizes = np.diff(np.append(starts, table.num_rows))
            group = np.repeat(np.arange(len(starts)), sizes)
            rep, n = table.column("rep").to_numpy(), table.column("n").to_numpy().astype(np.int64)
            raw = table.column("vec").to_pylist()
            side, vec = table.column("side").to_numpy(), _folded(raw, GROUPS)
            blocks = (table.column("s").to_numpy() != table.column("t").to_numpy())
            prev, key = table.column("prev").to_numpy(), table.column("key").to_numpy()
            comp = table.column("comp").to_numpy() if second else None
            left, right = [], []

            def wanted(i, j):
                """Pairs to look at: two classes, on two sides of a block pair,
                not met under the key before, not yet in one component."""
                ok = (rep[i] != rep[j]) & (~blocks[i] | (side[i] != side[j])) & ((prev[i] != prev[j]) | (prev[i] == key[i]))
                return ok & (comp[i] != comp[j]) if second else ok

            def add(i, j):
                left.append(rep[i])
                right.append(rep[j])

            small = np.flatnonzero((sizes <= LEAF)[group])
            edges = []
            if len(small):
                for i, j in _small_pairs(group[small], n[small], vec[small]):
                    i, j = small[i], small[j]
                    ok = wanted(i, j)
                    i, j = i[ok], j[ok]
                    if len(i):
                        rows, place = np.unique(np.concatenate([i, j]), return_inverse=True)
                        x, y, total = _Wide([raw[r] for r in rows], n[rows]).passing(place[:len(i)], place[len(i):])
                        x, y = rows[x], rows[y]
                        edges.append((x, y, total / (n[x] + n[y])))
            if edges:
                x, y, score = (np.concatenate(e) for e in zip(*edges))
                pick = slice(None) if second else spanning_forest(rep[x], rep[y], score)
                add(x[pick], y[pick])
            for g in np.flatnonzero(sizes > LEAF).tolist():
                at = np.arange(starts[g], starts[g] + sizes[g])
                if second and (comp[at] == comp[at[0]]).all():
                    continue
                best = np.full(len(at), -1.0)
                mate = np.zeros(len(at), dtype=np.int64)
                wide = _Wide([raw[x] for x in at], n[at])
                for i, j, total in RTree(n[at], vec[at]).pairs():
                    ok = wanted(at[i], at[j])
                    i, j, total = wide.passing(i[ok], j[ok], total[ok])
                    if second:
                        add(at[i], at[j])
                        continue
                    score = total / (n[at[i]] + n[at[j]])
                    for x, y in ((i, j), (j, i)):
                        order = np.argsort(score, kind="stable")
                        x, y, sc = x[order], y[order], score[order]
                        better = sc > best[x]
                        best[x[better]], mate[x[better]] = sc[better], y[better]  # the last write is the best
                if not second:
                    x = np.flatnonzero(best >= 0)
                    add(at[x], at[mate[x]])
            if left:
                a, b = np.concatenate(left), np.concatenate(right)
                pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def _possible(batches):
    """(a, b) of the pairs that the finer counts let pass."""
    for batch in batches:
        sizes = zip(batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist())
        fine = zip(batch.column("fine_a").to_pylist(), batch.column("fine_b").to_pylist())
        keep = pa.array([9 * fine_bound(x, y) >= 4 * (m + n) for (m, n), (x, y) in zip(sizes, fine)], type=pa.bool_())
        yield batch.select(["a", "b"]).filter(keep)


def _linked(batches):
    """(a, b) of the pairs whose sets link: 100 * overlap >= 80 * union."""
    for batch in batches:
        keep = []
        for r, (x, y) in enumerate(zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= 80 * (len(x) + len(y) - both):
                keep.append(r)
        yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(keep, type=pa.int64())),
                                          batch.column("b").take(pa.array(keep, type=pa.int64()))], ["a", "b"])


# -------------------------------------------------------------------- the join
def private_id(id_col: str, text_col: str) -> Column:
    """The id, or for a null id a negative number made from the text."""
    return F.coalesce(F.col(id_col).cast("bigint"),
                      -F.xxhash64(F.lit(8), F.col(text_col)).bitwiseAND(F.lit(POSITIVE)) - 1)


class JaccardJoin:
    """One run over ``docs`` (doc_id, text): ``rows`` has one row per input row
    (_id, doc_id, n, h1, h2), ``classes`` one per distinct shingle set
    (h1, h2, n, rep, low: the smallest doc_id), ``links`` (id, comp)."""

    def __init__(self, docs: DataFrame):
        spark = docs.sparkSession
        ship_package(spark)
        self.scratch = scratch = Scratch(spark, "jaccard")
        self.texts = docs.select(private_id("doc_id", "text").alias("_id"), F.col("doc_id").cast("bigint").alias("doc_id"),
                                 "text")
        heavy = spark.sparkContext.broadcast(heavy_shingles(self.texts))
        described = scratch.save(self.texts.mapInArrow(
            released(_describe(heavy)), "_id long, doc_id long, n int, h1 long, h2 long, keys array<long>, vec binary, "
            "wide binary, fine binary"),
            "described")
        self.rows = scratch.save(described.select("_id", "doc_id", "n", "h1", "h2"), "rows")
        reps = scratch.save(described.where("n > 0").groupBy("h1", "h2", "n").agg(
            F.min("_id").alias("rep"), F.min("doc_id").alias("low"), F.first("keys").alias("keys"),
            F.first("vec").alias("vec")), "reps")
        self.classes = reps.select("h1", "h2", "n", "rep", "low")
        shared = scratch.save(self._shared(reps), "shared")
        near = scratch.save(self._pairs(shared, reps.select("rep", "n", "vec")), "near")
        # a class that links with another is in a pair of the first pass: the
        # rest of the work is on these classes only
        met = near.select(F.col("a").alias("_id")).unionByName(near.select(F.col("b").alias("_id"))).distinct()
        points = scratch.save(_filtered(described, met).join(met, "_id", "left_semi").dropDuplicates(["_id", "h1", "h2"])
                              .select(F.col("_id").alias("rep"), "n", "wide", F.coalesce("fine", "wide").alias("fine")),
                              "points")
        scratch.drop("described")
        found = self._verify(near, points, "first")
        links = found.unionByName(self._one_document())
        stars = components(links, scratch, "stars")
        again = self._verify(self._pairs(
            self._mixed(shared, points, stars), points.select("rep", "n", F.col("wide").alias("vec")), second=True),
            points, "second")
        if again.limit(1).count():
            joined = again.unionByName(stars.select(F.col("comp").alias("a"), F.col("id").alias("b")))
            stars = components(joined, scratch, "joined")
        self.links = stars
        scratch.drop("shared", "near", "points")

    def _one_document(self) -> DataFrame:
        """Rows of one id are one document: links between its classes."""
        several = (self.rows.where("n > 0").groupBy("_id").agg(F.min("h1").alias("x"), F.max("h1").alias("y"))
                   .where("x <> y").select("_id"))
        return (self.rows.join(several, "_id").join(self.classes, ["h1", "h2", "n"])
                .select(F.col("rep").alias("a"), F.col("_id").alias("b")))

    def _shared(self, reps: DataFrame) -> DataFrame:
        """(key, s, t, side, rep, n, prev): classes under keys that others share.
        prev is the class's shared key before this one (the key itself: none).
        A hot key's rows are dealt to blocks, and a row goes to every pair
        (s, t) of blocks that holds its own."""
        rows = reps.select(F.explode("keys").alias("key"), "rep", "n")
        hot = (reps.where(F.pmod(F.xxhash64("rep"), F.lit(HOT_SAMPLE)) == 0).select(F.explode("keys").alias("key"))
               .groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") * HOT_SAMPLE >= BLOCK_ROWS)
               .orderBy(F.desc("c"), "key").limit(HOT_KEYS)
               .select("key", F.ceil(F.col("c") * HOT_SAMPLE / BLOCK_ROWS).cast("int").alias("blocks")))
        # at most HOT_KEYS rows of 12 bytes: a proven bound
        rows = (rows.join(F.broadcast(hot), "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
                .withColumn("_own", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks")).cast("int"))
                .withColumn("_other", F.explode(F.expr("sequence(0, blocks - 1)")))
                .select("key", F.least("_own", "_other").alias("s"), F.greatest("_own", "_other").alias("t"),
                        (F.col("_own") > F.col("_other")).cast("int").alias("side"), "rep", "n"))
        kind = "key long, s int, t int, side int, rep long, n int"
        rows = rows.repartition("key", "s", "t").sortWithinPartitions("key", "s", "t", "n", "rep")
        rows = rows.mapInArrow(released(_shared_rows), kind)
        before = Window.partitionBy("rep", "n").orderBy("key").rangeBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("prev", F.coalesce(F.max("key").over(before), "key"))
        rows = rows.repartition("key", "s", "t").sortWithinPartitions("key", "s", "t", "n", "rep")
        return rows.mapInArrow(released(_new_groups), kind + ", prev long")

    def _mixed(self, shared: DataFrame, points: DataFrame, stars: DataFrame) -> DataFrame:
        """Rows of the classes that have points, with their components, in
        groups of several components."""
        rows = (shared.join(points.select("rep").distinct(), "rep", "left_semi")
                .join(stars.select(F.col("id").alias("rep"), "comp"), "rep", "left")
                .withColumn("comp", F.coalesce("comp", "rep")))
        rows = rows.repartition("key", "s", "t").sortWithinPartitions("key", "s", "t")
        return rows.mapInArrow(released(_mixed_groups), rows.schema)

    def _pairs(self, shared: DataFrame, vectors: DataFrame, second: bool = False) -> DataFrame:
        rows = shared.join(vectors, ["rep", "n"])
        rows = rows.repartition("key", "s", "t").sortWithinPartitions("key", "s", "t", "n", "rep")
        return rows.mapInArrow(released(_candidates(second)), "a long, b long").distinct()

    def _verify(self, pairs: DataFrame, points: DataFrame, name: str) -> DataFrame:
        scratch = self.scratch
        fine = [points.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("fine").alias(f"fine_{x}"))
                for x in ("a", "b")]
        pairs = scratch.save(pairs.join(fine[1], "b").join(fine[0], "a")
                             .mapInArrow(released(_possible), "a long, b long").distinct(), f"pairs-{name}")
        needed = pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id"))).distinct()
        bits = self.texts.sparkSession.sparkContext.broadcast(_bits(needed))
        # sets that only share a place with a needed one find no pair below
        sets = scratch.save(self.texts.select("_id", "text", _place("_id").alias("place"))
                            .mapInArrow(released(_sets_of(bits)), "id long, set binary"), f"sets-{name}")
        both = (pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
                .join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a"))
        links = scratch.save(both.mapInArrow(released(_linked), "a long, b long").distinct(), f"links-{name}")
        scratch.drop(f"pairs-{name}", f"sets-{name}")
        return links

    def membership(self) -> DataFrame:
        """Every row with component_id (smallest doc_id reachable) and _keeper
        (the _id that stands for its component)."""
        comp = self.classes.join(self.links, self.classes["rep"] == self.links["id"], "left").select(
            "h1", "h2", "n", "low", "rep", F.coalesce("comp", "rep").alias("comp"))
        lows = comp.groupBy("comp").agg(F.min("low").alias("component_id"), F.min("rep").alias("_least"))
        named = comp.join(lows, "comp").select(
            "h1", "h2", "n", "component_id", F.coalesce("component_id", "_least").alias("_keeper"))
        linked = self.rows.join(named, ["h1", "h2", "n"], "left")
        return linked.select("_id", "doc_id", F.col("n").cast("bigint").alias("n_shingles"),
                             F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                             F.when(F.col("n") > 0, F.col("_keeper")).otherwise(F.col("_id")).alias("_keeper"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    Null, empty and wordless texts have no shingles and link with nothing.
    Rows of one doc_id are one document: its texts are linked with each
    other.  Rows with a null doc_id take part; their component_id is the
    smallest doc_id they reach, or null.  An empty table gives no rows.
    """
    return JaccardJoin(docs).membership().select("doc_id", "n_shingles", "component_id")


def keep_one_per_component(docs: DataFrame) -> DataFrame:
    """Columns of ``docs``: the document with the smallest id of each
    component, once, and every document without words."""
    own = private_id("doc_id", "text")
    lost = (JaccardJoin(docs).membership().where("n_shingles > 0 and _id <> _keeper").select("_id").distinct())
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), own.alias("_id"),
                         row_hash(docs).alias("_h"),
                         F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("_words"))
    kept = marked.join(lost, "_id", "left_anti")
    once = kept.where("_words").dropDuplicates(["_id"])
    return once.select("_row.*").unionByName(marked.where(~F.col("_words")).select("_row.*"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document."""
    return jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


OP8_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
      FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN c p ON p.doc_id = a JOIN c q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM c UNION SELECT r.a, l.b FROM reach r JOIN l ON l.a = r.b)
SELECT w.doc_id, coalesce(c.n, 0) AS n_shingles, coalesce(m.b, w.doc_id) AS component_id
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a) m USING (doc_id)
"""
