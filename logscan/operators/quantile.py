"""Exact percentiles (linear interpolation, as numpy's default) at any scale.

Spark's exact ``percentile`` aggregate merges every distinct value into one
task, which does not survive a global quantile over billions of scores.
Here the order statistics are found by radix selection instead:

* every value gets a 64-bit key whose unsigned order is the order of the
  doubles (vectorised in an Arrow batch, the only Python step);
* pass 0 is a histogram over the top 16 key bits, per group: a groupBy with
  map-side partial counts, so a hot value or group is pre-aggregated
  before the shuffle and the driver receives at most 65,536 rows per group;
* each later pass looks only at the 16-bit prefix that holds a wanted rank
  (broadcast join with a tiny table of prefixes) and splits the next 16 bits;
* a bucket whose min key equals its max key settles the rank early.

At most four passes give the exact value; most data settles after two.

Quantiles of many groups take another way, see ``grouped_quantiles``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscan.session import ship_package, work_dir

# Wanted rows of a grouped summary that are broadcast (about 60 bytes each); more are joined.
MAX_BROADCAST_PICKS = 500_000

_SIGN = np.int64(-0x8000000000000000)
_BITS = 16
_DIGITS = 1 << _BITS


@F.arrow_udf(T.LongType())
def _sortable_key(arr: pa.Array) -> pa.Array:
    """Order-preserving 64-bit key of a double (compare as unsigned)."""
    a = arr.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # -0.0 -> 0.0
    bits = a.view(np.int64)
    return pa.array(np.where(bits < 0, ~bits, bits | _SIGN), type=pa.int64())


# Declared non-deterministic only so that filters on the key (inferred by
# joins) are not pushed below it with the function inlined a second time.
sortable_key = _sortable_key.asNondeterministic()


def key_to_double(key: int) -> float:
    u = key & 0xFFFFFFFFFFFFFFFF
    bits = (u & 0x7FFFFFFFFFFFFFFF) if u >> 63 else (~u & 0xFFFFFFFFFFFFFFFF)
    return float(np.array([bits], dtype=np.uint64).view(np.float64)[0])


def _digit(pass_no: int):
    return F.shiftrightunsigned("_k", 64 - _BITS * (pass_no + 1)).bitwiseAND(F.lit(_DIGITS - 1))


def _lerp(a: float, b: float, t: float) -> float:
    """numpy's linear interpolation (its form for t >= 0.5 as well)."""
    d = b - a
    return b - d * (1.0 - t) if t >= 0.5 else a + d * t


class _Target:
    __slots__ = ("group", "rank", "prefix", "value")

    def __init__(self, group, rank):
        self.group, self.rank, self.prefix, self.value = group, rank, 0, None


def _settle(targets, hist, pass_no):
    """Walk each unsettled target through the histogram of its prefix."""
    for t in targets:
        if t.value is not None:
            continue
        buckets = hist.get((t.group, t.prefix), [])
        seen = 0
        for digit, cnt, kmin, kmax in buckets:
            if t.rank < seen + cnt:
                t.rank -= seen
                t.prefix = (t.prefix << _BITS) | digit
                if kmin == kmax or pass_no == 3:
                    t.value = key_to_double(kmin)
                break
            seen += cnt
        else:  # cannot happen with consistent counts
            raise RuntimeError("rank outside histogram")


def exact_quantiles(df: DataFrame, col: str, probs, by=(), stats: bool = False) -> list:
    """Exact quantiles of ``col``: ``[((), n, {p: value})]``, empty without rows.

    Nulls are ignored and NaN sorts above every number, as in Spark.  With
    ``stats=True`` each entry carries a fourth element ``{"min", "max",
    "sum"}`` gathered in the first pass, so a summary needs no separate scan.
    With ``by`` the entries of ``grouped_quantiles`` are collected, one per
    group; use that function itself where groups are many.
    """
    if by:
        names = list(by)
        rows = grouped_quantiles(df, col, probs, names).collect()
        out = [(tuple(r[c] for c in names), r["n"], {float(p): r[f"q{i}"] for i, p in enumerate(probs)},
                {"min": r["_min"], "max": r["_max"], "sum": r["_sum"]}) for r in rows]
        return sorted([e if stats else e[:3] for e in out], key=lambda e: tuple(str(x) for x in e[0]))
    by = []
    probs = [float(p) for p in probs]
    ship_package(df.sparkSession)
    value = F.col(col).cast("double")
    kept = [sortable_key(value).alias("_k")] + ([value.alias("_v")] if stats else [])
    base = (df.where(F.col(col).isNotNull()).select(*by, *kept)  # 8 bytes a row (+8 for stats)
            .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        def histogram(frame, pass_no, prefix_col, extra=False):
            keys = by + ([prefix_col] if prefix_col else [])
            aggs = [F.count(F.lit(1)).alias("_n"), F.min("_k").alias("_lo"), F.max("_k").alias("_hi")]
            if extra:
                aggs += [F.min("_v").alias("_vmin"), F.max("_v").alias("_vmax"), F.sum("_v").alias("_vsum")]
            rows = frame.groupBy(*keys, _digit(pass_no).alias("_d")).agg(*aggs).collect()
            out, more = {}, {}
            for r in rows:
                g = tuple(r[c] for c in by)
                pre = r[prefix_col] if prefix_col else 0
                out.setdefault((g, pre), []).append((r["_d"], r["_n"], r["_lo"], r["_hi"]))
                if extra:
                    more.setdefault(g, []).append((r["_vmin"], r["_vmax"], r["_vsum"]))
            for v in out.values():
                v.sort()
            return out, more

        hist, more = histogram(base, 0, None, extra=stats)
        sizes = {}
        for (g, _), buckets in hist.items():
            sizes[g] = sizes.get(g, 0) + sum(b[1] for b in buckets)

        plan, targets = {}, {}
        for g, n in sizes.items():
            for p in probs:
                h = (n - 1) * p
                lo = int(math.floor(h))
                hi = min(lo + 1, n - 1)
                plan[(g, p)] = (lo, hi, h - lo)
                for r in (lo, hi):
                    targets.setdefault((g, r), _Target(g, r))
        tlist = list(targets.values())
        _settle(tlist, hist, 0)

        spark = df.sparkSession
        for pass_no in (1, 2, 3):
            open_ = {(t.group, t.prefix) for t in tlist if t.value is None}
            if not open_:
                break
            schema = T.StructType(
                [base.schema[c] for c in by] + [T.StructField("_pre", T.LongType())])
            wanted = spark.createDataFrame([(*g, pre) for g, pre in open_], schema)
            framed = base.withColumn("_pre", F.shiftrightunsigned("_k", 64 - _BITS * pass_no))
            framed = framed.join(F.broadcast(wanted), by + ["_pre"])
            _settle(tlist, histogram(framed, pass_no, "_pre")[0], pass_no)

        result = []
        for g, n in sorted(sizes.items(), key=lambda kv: tuple(str(x) for x in kv[0])):
            vals = {}
            for p in probs:
                lo, hi, frac = plan[(g, p)]
                a, b = targets[(g, lo)].value, targets[(g, hi)].value
                vals[p] = _lerp(a, b, frac)
            if stats:
                parts = more[g]
                mins = [m for m, _, _ in parts if m is not None]
                info = {"min": min(mins) if mins else None,
                        "max": max((x for _, x, _ in parts), key=_nan_last),
                        "sum": math.fsum(s for _, _, s in parts)}
                result.append((g, n, vals, info))
            else:
                result.append((g, n, vals))
        return result
    finally:
        base.unpersist()


def grouped_quantiles(df: DataFrame, col: str, probs, by) -> DataFrame:
    """Exact quantiles per group as a DataFrame: [by...], n, _min, _max, _sum
    and q0, q1, ... in the order of ``probs``; any number of groups.

    One shuffle of the values: they are range-partitioned and sorted by group,
    value and a row hash (so a group or value that holds a third of all rows is
    cut into many partitions) and written once with their position.  A group's
    rows are neighbours in each partition, so its row counts per partition say
    at which positions the wanted ranks lie; only those rows are picked.  A
    null group is a group.
    """
    spark, by = df.sparkSession, list(by)
    work_dir(spark)
    keys = [F.col(c).alias(f"_g{k}") for k, c in enumerate(by)]
    groups = [f"_g{k}" for k in range(len(by))]
    base = (df.where(F.col(col).isNotNull()).select(*keys, (F.col(col).cast("double") + F.lit(0.0)).alias("_v"))
            .withColumn("_h", F.xxhash64(F.monotonically_increasing_id())).persist(StorageLevel.MEMORY_AND_DISK))
    try:
        n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        ranked = (base.repartitionByRange(n_parts, *groups, "_v", "_h").sortWithinPartitions(*groups, "_v")
                  .select(*groups, "_v", F.monotonically_increasing_id().alias("_at")).checkpoint(eager=True))
    finally:
        base.unpersist()
    # the upper bits of the position are the partition, the lower ones the row in it
    runs = ranked.groupBy(*groups, F.shiftrightunsigned("_at", 33).alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_c"),
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_v").alias("_s"))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("*", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"), F.sum("_c").over(whole).alias("n"),
                       F.min("_lo").over(whole).alias("_min"), F.max("_hi").over(whole).alias("_max"),
                       F.sum("_s").over(whole).alias("_sum"))
    place = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ranks = [F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"),
                      F.least(F.floor(h) + side, F.col("n") - 1).cast("bigint").alias("r"))
             for i, h in enumerate(place) for side in (0, 1)]
    own = F.filter(F.array(*ranks), lambda t: (t["r"] >= F.col("_off")) & (t["r"] < F.col("_off") + F.col("_c")))
    picks = (runs.select("*", F.explode(own).alias("t"))
             .select(*groups, "n", "_min", "_max", "_sum", "t.i", "t.side",
                     (F.col("_first") + F.col("t.r") - F.col("_off")).alias("_at")).checkpoint(eager=True))
    few = picks.count() <= MAX_BROADCAST_PICKS
    values = ranked.select("_at", "_v").join(F.broadcast(picks) if few else picks, "_at")
    out = values.groupBy(*groups, "n", "_min", "_max", "_sum").agg(
        *[F.max(F.when((F.col("i") == i) & (F.col("side") == side), F.col("_v"))).alias(f"_{i}_{side}")
          for i in range(len(probs)) for side in (0, 1)])
    for i, h in enumerate(place):
        t, a, b = h - F.floor(h), F.col(f"_{i}_0"), F.col(f"_{i}_1")
        out = out.withColumn(f"q{i}", F.when(t >= 0.5, b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t))
    return out.select(*[F.col(g).alias(c) for g, c in zip(groups, by)], "n", "_min", "_max", "_sum",
                      *[f"q{i}" for i in range(len(probs))])


def _nan_last(x: float):
    """Order key putting NaN above every number (Spark's ordering)."""
    return (1, 0.0) if isinstance(x, float) and math.isnan(x) else (0, x)


def exact_quantile(df: DataFrame, col: str, p: float):
    """One global quantile; None when there are no values."""
    res = exact_quantiles(df, col, [p])
    return res[0][2][float(p)] if res else None
