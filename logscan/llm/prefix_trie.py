"""Operator 13: the prefix trie of conversations, as balanced parentheses per shard.

A conversation is the path of its turns' digests (the first 16 bytes of the
SHA-256 of role and text: equal digests count as equal turns).  Paths are
range-partitioned and sorted, so the members of every trie node are
neighbours, also when thousands of conversations are copies of each other:
the conversation id is the last sort key and may be cut at.

Each partition is cut into shards of about ``SHARD_TURNS`` turns.  A shard
writes its part of the trie as balanced parentheses: walking the sorted paths,
the common prefix of neighbours says how many nodes close and open.  Blocks of
``BLOCK`` parentheses keep their minimum excess, in a binary tree of minima;
findclose climbs that tree and delimits every node's subtree.  The rank of
``()`` pairs inside it counts leaves; cumulative arrays over the nodes in
opening order give conversations and saved tokens.

Nodes on the first or last path of a shard (its spines) may go on in the next
one; all others are complete.  Spine rows are merged by node: members add up,
and each shard boundary corrects what both sides counted of the path they
share (a child, a leaf, one copy of each shared turn).  Members that end in a
node are hashed in id order; of a spine node each shard hands on one string of
ids, and the strings go through the hash in order, one at a time.

Nulls and odd input: turns are ordered by ``turn`` (null first), ties by digest;
a null role or text is an empty one; rows without a ``conv_id`` take no part;
repeated rows are turns of their own.  Texts of any length only enter as
digest and byte length.  Other columns are ignored, whatever their names.
An empty table gives no nodes.  One conversation's digests (24 bytes a turn)
must fit into a row, its texts need not.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logscan.llm.common import Scratch, read_table
from logscan.session import ship_package

SHARD_TURNS = 1 << 16
BLOCK = 64
DIGEST = 16
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# --------------------------------------------------- balanced parentheses
class Parentheses:
    """Findclose over a balanced sequence by a tree of block minima of the excess."""

    def __init__(self, is_open: np.ndarray):
        n = len(is_open)
        blocks = 1 << max(0, (-(-n // BLOCK) - 1).bit_length())
        self.excess = np.full(blocks * BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        self.excess[:n] = np.cumsum(np.where(is_open, 1, -1))
        self.minima = [self.excess.reshape(blocks, BLOCK).min(axis=1)]
        while len(self.minima[-1]) > 1:
            self.minima.append(self.minima[-1].reshape(-1, 2).min(axis=1))

    def _first_below(self, start: np.ndarray, level: np.ndarray) -> np.ndarray:
        """First position from ``start`` on, in its block, whose excess is below
        ``level``; -1 where the block has none."""
        found = np.full(len(start), -1, dtype=np.int64)
        left = np.arange(len(start))
        at = start.copy()
        while len(left):
            hit = self.excess[at[left]] < level[left]
            found[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] % BLOCK != 0]
        return found

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The closing position of each opening one."""
        level = self.excess[opens]
        inside = (opens + 1) % BLOCK != 0
        close = np.full(len(opens), -1, dtype=np.int64)
        close[inside] = self._first_below(opens[inside] + 1, level[inside])
        far = np.flatnonzero(close < 0)
        node, goal = opens[far] // BLOCK, level[far]
        top = np.full(len(far), -1)
        for k, low in enumerate(self.minima[:-1]):  # climb until a right neighbour holds a smaller excess
            up = np.flatnonzero(top < 0)
            right = up[node[up] % 2 == 0]
            right = right[low[node[right] + 1] < goal[right]]
            node[right] += 1
            top[right] = k
            still = np.flatnonzero(top < 0)
            node[still] //= 2
        for k in range(len(self.minima) - 2, -1, -1):  # and descend to the leftmost such block
            down = np.flatnonzero(top > k)
            node[down] *= 2
            node[down] += self.minima[k][node[down]] >= goal[down]
        close[far] = self._first_below(node * BLOCK, goal)
        return close


def _common_prefixes(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each path with the one before (0 first)."""
    lens = np.diff(offsets)
    short = np.minimum(lens[1:], lens[:-1])
    out = np.zeros(len(lens), dtype=np.int64)
    if not len(short) or not short.sum():
        return out
    firsts = np.cumsum(short) - short
    step = np.arange(short.sum()) - np.repeat(firsts, short)
    same = (flat[np.repeat(offsets[:-2], short) + step] == flat[np.repeat(offsets[1:-1], short) + step]).all(axis=1)
    miss = np.where(same, np.iinfo(np.int64).max, step)
    some = short > 0
    out[1:][some] = np.minimum(np.minimum.reduceat(miss, firsts[some]), short[some])
    return out


def _range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """min(values[first:last]) of every range (none empty), by doubled spans."""
    out = np.empty(len(first), dtype=values.dtype)
    width = np.floor(np.log2(last - first)).astype(np.int64)
    table = values
    for k in range(int(width.max(initial=0)) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        own = width == k
        out[own] = np.minimum(table[first[own]], table[last[own] - (1 << k)])
    return out


class Shard:
    """The trie of sorted paths: arrays by node in opening order."""

    def __init__(self, ids: np.ndarray, flat: np.ndarray, sizes: np.ndarray, offsets: np.ndarray):
        lens = np.diff(offsets)
        self.ids, self.flat, self.offsets, self.lens = ids, flat, offsets, lens
        shared = _common_prefixes(flat, offsets)
        new = lens - shared
        n = 1 + int(new.sum())
        # node 0 is the root; conversation i opens the nodes of depth shared + 1 .. len
        maker = np.repeat(np.arange(len(ids)), new)
        step = np.arange(n - 1) - np.repeat(np.cumsum(new) - new, new)
        self.depth = np.concatenate([[0], shared[maker] + step + 1])
        self.bytes = np.concatenate([[0], sizes[offsets[maker] + self.depth[1:] - 1]]).astype(np.int64)
        closes = np.concatenate([lens[:-1] - shared[1:], [lens[-1] + 1]])
        opened = np.concatenate([[1 + new[0]], new[1:]])
        is_open = np.repeat(np.tile([True, False], len(ids)), np.stack([opened, closes], axis=1).ravel())
        opens = np.flatnonzero(is_open)
        close = Parentheses(is_open).find_close(opens)
        nodes = np.arange(n)
        self.after = nodes + (close - opens + 1) // 2  # first node behind the subtree
        pairs = np.zeros(len(is_open) + 1, dtype=np.int64)
        np.cumsum(is_open[:-1] & ~is_open[1:], out=pairs[1:-1])
        pairs[-1] = pairs[-2]
        self.leaves = pairs[close] - pairs[opens]
        # the node where each conversation ends: the last one of its depth opened so far
        made = np.cumsum(new)
        order = np.lexsort((nodes, self.depth))
        key = self.depth[order] * n + nodes[order]
        self.end = order[np.searchsorted(key, lens * n + made, side="right") - 1]
        before = np.concatenate([[0], np.cumsum(np.bincount(self.end, minlength=n))])
        self.convs = before[self.after] - before[nodes]
        saved = np.concatenate([[0], np.cumsum((self.convs - 1) * self.bytes)])
        self.saved = saved[self.after] - saved[nodes]
        self.parent = np.full(n, -1)
        if n > 1:
            self.parent[1:] = order[np.searchsorted(key, (self.depth[1:] - 1) * n + nodes[1:], side="right") - 1]
        self.children = np.bincount(self.parent[1:], minlength=n)
        # members of a node are neighbours, by their end nodes in opening order
        self.low = _range_minima(ids, before[nodes], before[self.after])
        self.first_end = np.searchsorted(self.end, nodes, side="left")
        self.last_end = np.searchsorted(self.end, nodes, side="right")

    def path(self, i: int):
        return self.flat[self.offsets[i]:self.offsets[i + 1]]

    def spine(self) -> tuple[np.ndarray, np.ndarray]:
        """(on the first path, on the last path) flags by node."""
        first = np.zeros(len(self.depth), dtype=bool)
        first[:int(self.lens[0]) + 1] = True
        last = np.zeros(len(self.depth), dtype=bool)
        v = int(self.end[-1])
        while v >= 0:
            last[v] = True
            v = int(self.parent[v])
        return first, last


def path_keys(path: np.ndarray) -> list[bytes]:
    """A key for every prefix of a path, the root's first."""
    h = hashlib.sha256()
    out = [h.digest()]
    for digest in path:
        h.update(digest.tobytes())
        out.append(h.digest())
    return out


# --------------------------------------------------------- rows of a shard
_FIELDS = pa.schema([("kind", pa.string()), ("shard", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()),
                     ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
                     ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                     ("saved_tokens", pa.int64()), ("ends", pa.string()), ("place", pa.int64()),
                     ("path", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64()))])
_DDL = ("kind string, shard string, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, "
        "n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, place long, "
        "path array<binary>, sizes array<long>")


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{name: r.get(name) for name in _FIELDS.names} for r in rows], schema=_FIELDS)


def boundary_rows(last_path, first_path, sizes) -> list[dict]:
    """Corrections, by node, where a shard ends with ``last_path`` and the next
    one starts with ``first_path``: both counted every node of the common prefix."""
    common = 0
    while common < min(len(last_path), len(first_path)) and bytes(last_path[common]) == bytes(first_path[common]):
        common += 1
    rows, saved = [], 0
    keys = path_keys(np.array([np.frombuffer(bytes(p), dtype=np.uint8) for p in first_path[:common]]))
    for d in range(common, -1, -1):
        saved += int(sizes[d - 1]) if d else 0
        rows.append({"kind": "spine", "key": keys[d], "depth": d, "n_convs": 0, "saved_tokens": saved,
                     "n_children": -1 if d < common else 0, "n_leaves": -1 if len(last_path) == common else 0})
    return rows


def _shard_rows(s: Shard, name: str, place: int):
    """Node rows of a shard: complete ones, children of spines and spine rows."""
    first, last = s.spine()
    spine = first | last
    keys = {}
    for flag, path in ((first, s.path(0)), (last, s.path(len(s.ids) - 1))):
        for v, key in zip(np.flatnonzero(flag).tolist(), path_keys(path)):
            keys[v] = key
    text = [str(i) for i in s.ids.tolist()]
    out = []
    columns = zip(s.depth.tolist(), s.low.tolist(), s.parent.tolist(), s.convs.tolist(), s.children.tolist(),
                  s.leaves.tolist(), s.saved.tolist(), s.first_end.tolist(), s.last_end.tolist(), spine.tolist())
    for v, (depth, low, parent, convs, children, leaves, saved, a, b, on_spine) in enumerate(columns):
        ends = ",".join(text[a:b])
        row = {"conv_id": low, "depth": depth, "n_convs": convs, "n_children": children, "n_leaves": leaves,
               "saved_tokens": saved}
        if on_spine:
            row |= {"kind": "spine", "shard": name, "key": keys[v], "parent_key": keys.get(parent), "ends": ends or None,
                    "place": place}
        else:
            row |= {"kind": "child" if spine[parent] else "inner",
                    "ends": hashlib.sha256(ends.encode()).hexdigest() if ends else EMPTY_SHA}
            if spine[parent]:
                row |= {"shard": name, "parent_key": keys[parent]}
            else:
                row |= {"parent_conv_id": int(s.low[parent])}
        out.append(row)
        if len(out) == 4096:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _shards(shard_turns: int):
    """Batches of sorted (conv_id, path, sizes) to node, spine and edge rows."""

    def run(batches):
        partition = TaskContext.get().partitionId()
        held, turns, number, last, edge = [], 0, 0, None, None

        def flush():
            nonlocal held, turns, number, last, edge
            ids = np.concatenate([h[0] for h in held])
            flat = np.concatenate([h[1] for h in held])
            sizes = np.concatenate([h[2] for h in held])
            offsets = np.concatenate([[0], np.cumsum(np.concatenate([h[3] for h in held]))])
            s = Shard(ids, flat, sizes, offsets)
            own = [bytes(p) for p in s.path(0)], sizes[:int(s.lens[0])].tolist()
            if last is None:
                edge = own
            else:
                yield _batch(boundary_rows(last, *own))
            yield from _shard_rows(s, f"{partition}-{number}", number)
            last = [bytes(p) for p in s.path(len(ids) - 1)]
            held, turns, number = [], 0, number + 1

        for batch in batches:
            paths, sizes = batch.column("path"), batch.column("sizes")
            lens = np.diff(paths.offsets.to_numpy())
            values = paths.flatten()
            flat = np.frombuffer(b"".join(values.to_pylist()), dtype=np.uint8).reshape(-1, DIGEST)
            size = sizes.flatten().to_numpy()
            ids = batch.column("conv_id").to_numpy()
            at, bounds = 0, np.concatenate([[0], np.cumsum(lens)])
            while at < len(ids):  # a shard ends once it holds shard_turns turns (or as many conversations)
                room = max(1, shard_turns - turns)
                to = int(np.searchsorted(bounds + np.arange(len(bounds)), bounds[at] + at + room))
                to = min(max(to, at + 1), len(ids))
                lo, hi = bounds[at], bounds[to]
                held.append((ids[at:to], flat[lo:hi], size[lo:hi], lens[at:to]))
                turns += int(hi - lo) + to - at
                at = to
                if turns >= shard_turns:
                    yield from flush()
        if held:
            yield from flush()
        if edge is not None:
            yield _batch([{"kind": "edge", "place": partition, "path": edge[0], "sizes": edge[1]},
                          {"kind": "tail", "place": partition, "path": last}])
    return run


def _edge_corrections(batches):
    for batch in batches:
        for last, first, sizes in zip(*(batch.column(c).to_pylist() for c in ("last", "first", "sizes"))):
            rows = boundary_rows(last, first, sizes)
            for i in range(0, len(rows), 4096):
                yield _batch(rows[i:i + 4096])


def _chained_hashes(batches):
    """(key, ends) of ids sorted by (key, place): strings of one key go through
    one hash, one at a time."""
    key, h, keys, out = None, None, [], []
    for batch in batches:
        for k, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k != key:
                if h is not None:
                    keys.append(key)
                    out.append(h.hexdigest())
                key, h = k, hashlib.sha256(ends.encode())
            else:
                h.update(b"," + ends.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())], ["key", "ends"])
        keys, out = [], []
    if h is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()], pa.string())],
                                         ["key", "ends"])


# -------------------------------------------------------------------- paths
def _digested(turns: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)), 256)
    return turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.unhex(F.substring(whole, 1, 2 * DIGEST)).alias("digest"), role.alias("role"), text.alias("text"))


def turn_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): per conversation its ordered (turn, digest, bytes)."""
    row = F.struct("turn", "digest", F.octet_length("text").cast("bigint").alias("bytes"))
    return _digested(turns).groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))


def trie_nodes(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Every trie node of ``paths`` (conv_id, turns as in ``turn_paths``; one row
    per conversation): conv_id (its smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens (bytes of the repeated turns in
    its subtree) and ends_sha256 (of the ids that end here)."""
    spark = paths.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "prefix_trie")
    rows = scratch.save(paths.select("conv_id", F.col("turns.digest").alias("path"), F.col("turns.bytes").alias("sizes")),
                        "paths")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = scratch.save(ordered.mapInArrow(_shards(shard_turns), _DDL), "parts")

    # partitions without rows are skipped: their numbers are all the driver sees
    used = sorted(r["place"] for r in parts.where("kind = 'edge'").select("place").collect())
    spine = parts.where("kind = 'spine'").select("key", "conv_id", "depth", "n_convs", "n_children", "n_leaves",
                                                 "saved_tokens")
    follows = spark.createDataFrame(list(zip(used, used[1:])), "place long, next long")
    tails = parts.where("kind = 'tail'").join(follows, "place").select(F.col("next").alias("place"),
                                                                       F.col("path").alias("last"))
    heads = parts.where("kind = 'edge'").select("place", F.col("path").alias("first"), "sizes")
    fixes = heads.join(tails, "place").mapInArrow(_edge_corrections, _DDL)
    spine = spine.unionByName(fixes.select(*spine.columns))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = scratch.save(spine.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *sums),
                          "merged")

    ends = (parts.where("kind = 'spine' AND ends IS NOT NULL")
            .select("key", "ends", F.split("shard", "-")[0].cast("int").alias("part"), "place")
            .repartition("key").sortWithinPartitions("key", "part", "place").select("key", "ends")
            .mapInArrow(_chained_hashes, "key binary, ends string"))
    low = merged.select("key", "conv_id")
    # each shard knows its own spine: the smallest members come back per shard,
    # so that the root's children are spread over the shards
    own = (parts.where("kind = 'spine' AND shard IS NOT NULL").select("shard", "key", "parent_key"))
    shard_low = own.select("shard", "key").join(low, "key").select(
        "shard", F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    child = parts.where("kind = 'child'").drop("parent_conv_id").join(shard_low, ["shard", "parent_key"])
    parents = own.where("parent_key IS NOT NULL").select("key", "parent_key").distinct()
    above = parents.join(low.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")),
                         "parent_key").select("key", "parent_conv_id")
    merged = (merged.join(above, "key", "left").join(ends, "key", "left")
              .withColumn("ends", F.coalesce("ends", F.lit(EMPTY_SHA))))
    columns = [F.col("ends").alias(c) if c == "ends_sha256" else F.col(c) for c in NODE]
    return (parts.where("kind = 'inner'").select(*columns).unionByName(child.select(*columns))
            .unionByName(merged.select(*columns)))


def conversation_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of a table of turns (conv_id, turn, role, text)."""
    return trie_nodes(turn_paths(turns), shard_turns)


def node_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` of ``conversation_trie`` with role and text of their last turn:
    the ``depth``-th one of the smallest member (null at the root)."""
    at = turn_paths(turns).select("conv_id", F.posexplode("turns").alias("k", "t")).select(
        "conv_id", (F.col("k") + 1).cast("bigint").alias("depth"), "t.turn", "t.digest")
    texts = _digested(turns).dropDuplicates(["conv_id", "turn", "digest"]).select(
        F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("digest").alias("_d"), "role", "text")
    own = at.join(texts, (F.col("conv_id") == F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))
                  & (F.col("digest") == F.col("_d"))).select("conv_id", "depth", "role", "text")
    return nodes.join(own, ["conv_id", "depth"], "left")


# -------------------------------------------------------------------- query
def rebuilt_paths(turns: DataFrame) -> DataFrame:
    """Paths of the rebuilt conversations: the first h turns of conversation
    c - c % 5, then c's own turns after its first h, h = crc32(c) % 9."""
    own = turn_paths(turns)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    base = own.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    none = F.filter(F.col("turns"), lambda t: F.lit(False))
    rest = F.when(F.size("turns") > F.col("h"),
                  F.slice(F.col("turns"), F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))).otherwise(none)
    return (own.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(base, "base", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), rest).alias("turns")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the rebuilt conversations."""
    return trie_nodes(rebuilt_paths(read_table(spark, sf_dir, "conversations")))


# crc32 of a decimal text: the table of its polynomial, then one step a byte.
OP13_SQL = """
WITH RECURSIVE crc_step(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc_step WHERE k = 8),
turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
                 coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base,
                 xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
                       lambda p: CAST(ascii(substr(CAST(conv_id AS VARCHAR), p, 1)) AS BIGINT)),
                     lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h
          FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
rebuilt AS (SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
            UNION ALL SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
path AS (SELECT c.conv_id, coalesce(list(sha256(length(r.role) || ':' || r.role || r.text) ORDER BY r.pos)
                  FILTER (WHERE r.pos IS NOT NULL), []) AS p,
                coalesce(list(CAST(strlen(r.text) AS BIGINT) ORDER BY r.pos) FILTER (WHERE r.pos IS NOT NULL), []) AS b
         FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id),
member AS (SELECT conv_id, d AS depth, array_to_string(p[1:d], ',') AS node, array_to_string(p[1:d - 1], ',') AS up,
                  len(p) AS n, CASE WHEN d = 0 THEN 0 ELSE b[d] END AS bytes
           FROM path, unnest(range(0, len(p) + 1)) AS u(d)),
node AS (SELECT depth, node, min(conv_id) AS conv_id, min(up) AS up, count(*) AS n_convs, min(bytes) AS bytes,
                sha256(coalesce(string_agg(CASE WHEN n = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends
         FROM member GROUP BY depth, node),
kids AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1, 2),
sub AS (SELECT a.depth, a.node, count(*) FILTER (WHERE k.n IS NULL) AS n_leaves, sum((b.n_convs - 1) * b.bytes) AS saved
        FROM node b LEFT JOIN kids k ON k.depth = b.depth AND k.node = b.node
        JOIN (SELECT DISTINCT m.depth, m.node, w.depth AS low_depth, w.node AS low FROM member m JOIN member w
              ON w.conv_id = m.conv_id AND w.depth >= m.depth) a ON a.low_depth = b.depth AND a.low = b.node
        GROUP BY a.depth, a.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(k.n, 0) AS n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM node n LEFT JOIN node p ON p.depth = n.depth - 1 AND p.node = n.up AND n.depth > 0
LEFT JOIN kids k ON k.depth = n.depth AND k.node = n.node JOIN sub s ON s.depth = n.depth AND s.node = n.node
"""
