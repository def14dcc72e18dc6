"""Operator 1: byte-balanced shards by histogram sort (native).

Rows are ordered by a two-part 62-bit key: the hash of the text (or a key
given by the caller), then the hash of the id.  Splitters between shards are
found as in a histogram sort: each round counts the exact bytes below evenly
spaced candidate boundaries inside every interval that still holds a wanted
splitter, keeps the candidates that meet the tolerance, and narrows the
other intervals to the one bucket that holds the target.  A key that alone
holds more than a shard (a group of copies) is split by the second part.
Only then the rows move, once.

Position within a shard: a shard is cut into blocks by the second key part,
which no group of copies can overload; block row counts, taken on the narrow
key table, give each block its first slot, and a row number inside the block
does the rest.  No shard is ever sorted or numbered by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logscan.llm.common import POSITIVE, Scratch, positive_hash, read_table, row_hash, without

N_SHARDS = 16
TOLERANCE = 0.0005   # of a shard's bytes, for each splitter
PROBES = 1024        # candidate boundaries per open interval and round
BLOCK_BYTES = 64 << 20
MIN_BLOCKS = 64      # blocks per shard at least, so that all cores share the numbering


class _Interval:
    """Keys [lo, hi] of one level: level 0 is the first key part, level 1 the
    second part under a fixed first part; ``below`` bytes lie before it."""

    __slots__ = ("first", "lo", "hi", "below")

    def __init__(self, first, lo, hi, below):
        self.first, self.lo, self.hi, self.below = first, lo, hi, below

    def key(self):
        return (self.first, self.lo, self.hi)

    def step(self):
        return max(1, -(-(self.hi - self.lo + 1) // PROBES))

    def digit(self, j: int) -> Column:
        part = "_k1" if self.first is None else "_k2"
        hit = F.col(part).between(self.lo, self.hi)
        if self.first is not None:
            hit &= F.col("_k1") == self.first
        bucket = F.expr(f"({part} - {self.lo}L) div {self.step()}L")
        return F.when(hit, F.lit(j * (PROBES + 1)) + bucket)

    def point(self, k: int) -> tuple[int, int]:
        return (k, 0) if self.first is None else (self.first, k)


def _settle(iv: _Interval, buckets, target: float, tol: float):
    """The splitter (a key; the right shard starts there), or the narrower interval."""
    cum = iv.below
    for i, (size, lo, hi) in enumerate(buckets):
        if cum + size < target and i + 1 < len(buckets):
            cum += size
            continue
        left, right = target - cum, cum + size - target
        single = lo == hi
        if min(abs(left), abs(right)) <= tol or (single and iv.first is not None):
            return iv.point(lo) if abs(left) <= abs(right) else iv.point(hi + 1)
        if single:
            return _Interval(lo, 0, POSITIVE, cum)
        return _Interval(iv.first, lo, hi, cum)
    return iv.point(iv.hi + 1)


def find_splitters(keys: DataFrame, n_shards: int, tolerance: float = TOLERANCE):
    """(total bytes, rows, splitters): the n_shards - 1 keys where shards begin.

    ``keys`` holds _k1, _k2 and size.  The driver receives at most PROBES
    counts per open interval and round.
    """
    total, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not rows:
        return 0, 0, []
    share = total / n_shards
    open_ = {i: _Interval(None, 0, POSITIVE, 0) for i in range(1, n_shards)}
    found: dict[int, tuple[int, int]] = {}
    while open_:
        ivs = list({iv.key(): iv for iv in open_.values()}.values())
        index = {iv.key(): j for j, iv in enumerate(ivs)}
        digit = F.coalesce(*[iv.digit(j) for j, iv in enumerate(ivs)])
        part = F.coalesce(*[F.when(iv.digit(j).isNotNull(), F.col("_k1" if iv.first is None else "_k2"))
                            for j, iv in enumerate(ivs)])
        counts = (keys.select(digit.alias("_d"), part.alias("_p"), "size").where("_d is not null")
                  .groupBy("_d").agg(F.sum("size"), F.min("_p"), F.max("_p")).collect())
        hist: dict[int, list] = {}
        for d, size, lo, hi in sorted(tuple(r) for r in counts):
            hist.setdefault(d // (PROBES + 1), []).append((size, lo, hi))
        for i, iv in list(open_.items()):
            res = _settle(iv, hist.get(index[iv.key()], []), share * i, tolerance * share)
            if isinstance(res, tuple):
                found[i] = res
                del open_[i]
            else:
                open_[i] = res
    return total, rows, sorted(found.values())


def _shard_of(splitters, first: int = 0) -> Column:
    """Number of splitters at or below a row's key, as a balanced decision tree."""
    if not splitters:
        return F.lit(first)
    mid = len(splitters) // 2
    k1, k2 = splitters[mid]
    left = (F.col("_k1") < k1) | ((F.col("_k1") == k1) & (F.col("_k2") < k2))
    return F.when(left, _shard_of(splitters[:mid], first)).otherwise(
        _shard_of(splitters[mid + 1:], first + mid + 1))


def shard_by_bytes(docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text",
                   key: Column | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """All rows with ``size``, ``shard`` (0 to n_shards - 1) and ``slot``.

    Shards are key ranges whose bytes differ from an equal share by at most
    the tolerance, or by one key where a single row is larger than that.
    Equal texts are neighbours in the order, so they share a shard unless a
    splitter falls among them.  ``key`` replaces the text hash as the first
    part: a bigint column from 0 to 2^62 - 1.

    A null text has size 1 (no bytes plus one) and a hash of its own; a null
    id counts as one more id.  Rows equal in id and text have one key and
    stay in one shard.  An empty table gives an empty result.  Input columns
    named size, shard or slot (any case) are replaced.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    text = F.col(f"`{text_col}`")
    k1 = F.coalesce(key.cast("bigint"), F.lit(0)) if key is not None else positive_hash(text)
    k2 = positive_hash(F.col(f"`{id_col}`"), text)
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")
    keys = scratch.save(docs.select(k1.alias("_k1"), k2.alias("_k2"), size.alias("size")), "keys")
    total, _, splitters = find_splitters(keys, n_shards, tolerance)

    blocks = max(MIN_BLOCKS, -(-total // (n_shards * BLOCK_BYTES)))
    placed = (_shard_of(splitters).cast("int").alias("shard"),
              F.pmod(F.col("_k2"), F.lit(blocks)).cast("int").alias("_block"))
    firsts = (keys.select(*placed).groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_from", F.sum("_n").over(
                  Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)))
              .select("shard", "_block", F.coalesce("_from", F.lit(0)).alias("_from")))
    kept = without(docs, ("size", "shard", "slot"))
    rows = (docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), size.alias("size"),
                        k1.alias("_k1"), k2.alias("_k2"), row_hash(docs).alias("_k3"))
            .select("_row", "size", "_k1", "_k2", "_k3", *placed)
            .join(firsts, ["shard", "_block"]))
    in_block = Window.partitionBy("shard", "_block").orderBy("_k1", "_k2", "_k3")
    return (rows.withColumn("slot", F.col("_from") + F.row_number().over(in_block) - 1)
            .select("_row.*", "size", "shard", "slot"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes (law ``bytes``).

    A null text has no checksum (null)."""
    out = shard_by_bytes(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", F.crc32(F.col("text")).alias("text_crc32"), F.lit("bytes").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
