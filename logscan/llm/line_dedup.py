"""Operator 7: line dedup by winnowing over line hashes.

A document is its sequence of line hashes.  A window is the shortest run of
lines from some line on that holds ``WINDOW_WORDS`` words; the smallest line
hash of each window (the rightmost of equal ones) is a fingerprint.  A
repeated run of twice that many words holds a whole window, so both of its
copies select the same line there, and the shortest window of that many words
forward or backward from the selected line lies inside the run.  These two
windows are the fingerprint's keys: equal keys are equal text.

Fingerprints join the first document that has their key (the smallest id).  From
all its places a match is extended both ways, line by line, and the later copy of
the run is deleted.  An earlier place elsewhere that agrees for longer agrees with
the first document just as far, so it belongs to a later row of the same key that
stopped at the same line: in the next round these rows are keyed by their run and
the line it stopped before (one key each way), join the first document of that key,
and so on until no key repeats.  Every earlier place of a fingerprint is thereby
compared, without making pairs of them.  Every deleted line has an equal line at an
earlier place, so the first copy of a text stays.
"""

from __future__ import annotations

import bisect
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscan.llm.common import POSITIVE, Scratch, read_table, without
from logscan.session import ship_package

WINDOW_WORDS = 25    # repeated runs of 50 words or more are always found
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def line_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and word count of every line (lines end at a line feed)."""
    lines = (text or "").encode().split(b"\n") if text else []
    return (np.array([xxhash.xxh3_64_intdigest(x) for x in lines], dtype=np.uint64),
            np.array([len(x.split()) for x in lines], dtype=np.int64))


def fingerprints(hashes: np.ndarray, words: np.ndarray, window: int = WINDOW_WORDS):
    """(key, first line, number of lines) of the windows at selected lines."""
    cum = np.concatenate([[0], np.cumsum(words)])
    if cum[-1] < window:
        return []
    ends = np.searchsorted(cum, cum[:-1] + window, side="left")   # line after the window from line i
    starts = np.searchsorted(cum, cum[1:] - window, side="right") - 1  # first line of the window up to line i
    # lines without words are never selected: a window is looked at as its lines
    # with words, at most ``window`` of them, however many blank ones lie between
    full = np.flatnonzero(words > 0)
    value, stops = hashes[full], np.searchsorted(full, ends[full], side="left")
    chosen = set()
    for i, (e, stop) in enumerate(zip(ends[full].tolist(), stops.tolist())):
        if e > len(words):
            break
        chosen.add(int(full[stop - 1 - int(np.argmin(value[i:stop][::-1]))]))
    out = set()
    for p in chosen:
        for a, e in ((p, int(ends[p])), (int(starts[p]), p + 1)):
            if 0 <= a and e <= len(words):
                key = xxhash.xxh3_64_intdigest(hashes[a:e].tobytes())
                out.add((key - (1 << 64) if key >> 63 else key, a, e - a))
    return sorted(out, key=lambda x: (x[1], x[2]))


def _lines(batches):
    for batch in batches:
        hs, ws = zip(*[line_hashes(t) for t in batch.column("text").to_pylist()]) if batch.num_rows else ((), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("th"), pa.array([h.view(np.int64) for h in hs], type=pa.list_(pa.int64())),
             pa.array(ws, type=pa.list_(pa.int64()))], ["id", "th", "lines", "words"])


def _arrays(col) -> list[np.ndarray]:
    return [v.values.to_numpy(zero_copy_only=False) for v in col]


BOTH, BACK, ON = 0, -1, 1  # ways in which a window's match is extended
_MARK = "key long, id long, th long, lines array<int>, n int, way int"
_FOUND = ("id long, th long, runs array<struct<b:int,e:int>>, "
          "next array<struct<key:bigint,lines:array<int>,n:int,way:int>>")


def _fingerprint_rows(window: int):
    """One row per key of a document: the places of its windows."""
    def run(batches):
        for batch in batches:
            rows = []
            for i, th, h, w in zip(batch.column("id").to_pylist(), batch.column("th").to_pylist(),
                                   _arrays(batch.column("lines")), _arrays(batch.column("words"))):
                places: dict[tuple, list] = {}
                for key, a, n in fingerprints(h.view(np.uint64), w, window):
                    places.setdefault((key, n), []).append(a)
                rows += [(key, i, th, at, n, BOTH) for (key, n), at in places.items()]
            cols = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()),
                                                            pa.int32(), pa.int32()))],
                ["key", "id", "th", "lines", "n", "way"])

    return run


def extend(a: np.ndarray, b: np.ndarray, at: int, other: int, n: int) -> tuple[int, int]:
    """The longest run [from, to) of ``a`` around lines at..at + n that equals
    ``b`` around ``other``."""
    lo, hi, shift = at, at + n, other - at
    while lo > 0 and lo + shift > 0 and a[lo - 1] == b[lo + shift - 1]:
        lo -= 1
    while hi < len(a) and hi + shift < len(b) and a[hi] == b[hi + shift]:
        hi += 1
    return lo, hi


class _Suffixes:
    """How many lines agree from a line of ``a`` and a line of ``b`` on: ranks
    of the runs of 1, 2, 4, ... lines that start at every line of both."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.shift = len(a) + 1
        n = self.shift + len(b) + 1
        rank = np.zeros(n, dtype=np.int64)  # 0, 1: the ends of the texts, equal to nothing
        rank[len(a)] = 1
        at = np.r_[0:len(a), self.shift:n - 1]
        rank[at] = np.unique(np.concatenate([a, b]), return_inverse=True)[1] + 2
        self.levels, size = [], 1
        while True:
            self.levels.append(rank.astype(np.int32))
            if size >= n or rank.max() + 1 == n:
                break
            follow = np.zeros(n, dtype=np.int64)
            follow[:n - size] = rank[size:]
            rank = np.unique(rank * (n + 1) + follow, return_inverse=True)[1]
            size *= 2
        self.order = self.levels[-1]

    def agree(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Lines that agree from the joint positions x and y on, pair by pair."""
        x, y, out = x.copy(), y.copy(), np.zeros(len(x), dtype=np.int64)
        last = len(self.order) - 1
        for k in range(len(self.levels) - 1, -1, -1):
            # the ends of the texts are unlike anything, so equal runs lie inside both
            step = (self.levels[k][x] == self.levels[k][y]).astype(np.int64) << k
            out += step
            x, y = np.minimum(x + step, last), np.minimum(y + step, last)
        return out

    def longest(self, at: np.ndarray, places: np.ndarray) -> np.ndarray:
        """For each line of ``a``: the most lines that agree with any of the
        ``places`` of ``b``, which are its neighbours in the order of suffixes."""
        joint = places + self.shift
        joint = joint[np.argsort(self.order[joint], kind="stable")]
        i = np.searchsorted(self.order[joint], self.order[at])
        return np.maximum(self.agree(at, joint[np.maximum(i - 1, 0)]),
                          self.agree(at, joint[np.minimum(i, len(joint) - 1)]))

    def longest_before(self, at: np.ndarray) -> np.ndarray:
        """For each line of ``a``, where ``b`` is the same text: the most lines
        that agree with any line before it in the list ``at`` (0 for the first).
        Lines are taken out of the order of suffixes from the last one on, so the
        neighbours that a line has left come before it."""
        by = np.argsort(self.order[at], kind="stable")
        left, right = np.full(len(at), -1), np.full(len(at), -1)
        left[by[1:]], right[by[:-1]] = by[:-1], by[1:]
        left, right = left.tolist(), right.tolist()
        for k in range(len(at) - 1, -1, -1):
            u, v = left[k], right[k]
            if u >= 0:
                right[u] = v
            if v >= 0:
                left[v] = u
        out = np.zeros(len(at), dtype=np.int64)
        for side in (np.array(left), np.array(right)):
            k = np.flatnonzero(side >= 0)
            out[k] = np.maximum(out[k], self.agree(at[k], at[side[k]] + self.shift))
        return out


def _matches(a: np.ndarray, b: np.ndarray, hits: list, same: bool):
    """(hit, line, from, to): the longest run around each window of ``a`` that
    agrees with any of its places in ``b`` (above it, in the same text)."""
    runs: dict[int, list] = {}  # by how far ``b`` lies ahead: disjoint runs, rising
    many = []
    for h in hits:
        n, lines, places = h["n"], np.array(h["lines"], dtype=np.int64), np.array(h["first"], dtype=np.int64)
        if len(places) > (2 if same else 1):
            many.append((h, lines, places))
            continue
        for at in lines.tolist():
            other = int(places[0])
            if same and other >= at:
                continue
            own = runs.setdefault(other - at, [])
            k = bisect.bisect_right(own, (at, len(a) + 1)) - 1
            run = own[k] if k >= 0 and at + n <= own[k][1] else None
            # a hash clash of keys would show here: the lines themselves must agree
            if not run and np.array_equal(a[at:at + n], b[other:other + n]):
                run = extend(a, b, at, other, n)
                bisect.insort(own, run)
            if run:
                yield h, at, *run
    if many:
        on, back = _Suffixes(a, b), _Suffixes(a[::-1], b[::-1])
        for h, lines, places in many:
            n = h["n"]
            if same:  # the windows of a key in its first document are its places
                lines = np.union1d(lines, places)
                x, y = on.longest_before(lines), back.longest_before(len(a) - lines - n)
            else:
                x, y = on.longest(lines, places), back.longest(len(a) - lines - n, len(b) - places - n)
            for at, u, v in zip(lines.tolist(), x.tolist(), y.tolist()):
                if min(u, v) >= n:
                    yield h, at, at + n - v, at + u


def _longer_key(key: int, way: int, lines: np.ndarray) -> int:
    """Key of a window of ``key`` grown one way to ``lines``."""
    h = xxhash.xxh3_64_intdigest(lines.tobytes() + bytes([way + 1]), seed=key & int(_LAST))
    return h - (1 << 64) if h >> 63 else h


def _runs(batches):
    """Matches of one document with the first one of their keys (an earlier one
    or itself) -> runs to delete, and the windows grown by the line at which
    a match stopped."""
    for batch in batches:
        out, grown = [], []
        for a, b, same, hits in zip(_arrays(batch.column("lines")), _arrays(batch.column("first_lines")),
                                    batch.column("same").to_pylist(), batch.column("hits").to_pylist()):
            runs, longer = set(), {}
            for h, at, lo, hi in _matches(a, b, hits, same):
                runs.add((lo, hi))
                if not same and h["way"] != BACK and hi < len(a):
                    longer.setdefault((_longer_key(h["key"], ON, a[at:hi + 1]), hi + 1 - at, ON), []).append(at)
                end = at + h["n"]
                if not same and h["way"] != ON and lo > 0:
                    longer.setdefault((_longer_key(h["key"], BACK, a[lo - 1:end]), end - lo + 1, BACK), []).append(lo - 1)
            out.append([{"b": lo, "e": hi} for lo, hi in sorted(runs)])
            grown.append([{"key": k, "lines": sorted(at), "n": n, "way": w} for (k, n, w), at in sorted(longer.items())])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("th"),
             pa.array(out, type=pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())]))),
             pa.array(grown, type=pa.list_(pa.struct([("key", pa.int64()), ("lines", pa.list_(pa.int32())),
                                                      ("n", pa.int32()), ("way", pa.int32())])))],
            ["id", "th", "runs", "next"])


@F.arrow_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()),
                           T.StructField("removed_lines", T.LongType()), T.StructField("removed_words", T.LongType())]))
def _cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
    rows = []
    for text, cuts in zip(texts.to_pylist(), runs.to_pylist()):
        lines = text.split("\n") if text else []
        gone = np.zeros(len(lines), dtype=bool)
        for c in cuts or ():
            gone[c["b"]:c["e"]] = True
        rows.append({"text": "\n".join(x for x, g in zip(lines, gone) if not g) if gone.any() else text,
                     "n_lines": len(lines), "removed_lines": int(gone.sum()),
                     "removed_words": sum(len(x.encode().split()) for x, g in zip(lines, gone) if g)})
    return pa.array(rows, type=pa.struct([("text", pa.string()), ("n_lines", pa.int64()),
                                          ("removed_lines", pa.int64()), ("removed_words", pa.int64())]))


OUTPUT = ("text", "n_lines", "removed_lines", "removed_words")


def dedup_lines(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """All rows of ``docs`` with later copies of repeated line runs cut out of
    ``text``, and n_lines, removed_lines, removed_words.

    A run is deleted when it holds a fingerprint window (``window`` words or
    more) that occurred earlier, as far as it agrees with any of the earlier
    places: at a smaller doc_id (rows with a null id come last), or further up in
    the same text.  Null and empty texts have no lines
    and stay; rows equal in id and text count as one document and are cut
    alike; an empty table gives no rows.  Input columns named n_lines,
    removed_lines or removed_words are replaced.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "lines")
    own = F.coalesce(F.col("doc_id").cast("bigint"),
                     F.xxhash64("text").bitwiseAND(F.lit(POSITIVE)) + F.lit(1 << 62))
    key = (own.alias("id"), F.xxhash64("text").alias("th"))
    lines = scratch.save(docs.select(*key, "text").mapInArrow(
        _lines, "id long, th long, lines array<long>, words array<long>"), "lines")
    once = lines.dropDuplicates(["id", "th"])
    level = scratch.save(once.mapInArrow(_fingerprint_rows(window), _MARK), "marks")
    once, found, doc = once.drop("words"), [], F.struct("id", "th")
    while True:
        step = len(found)
        # one row per repeated key: its first document (minima are taken before the shuffle)
        firsts = scratch.save(
            level.groupBy("key").agg(F.min(F.struct("id", "th", "lines")).alias("f"), F.count(F.lit(1)).alias("c"))
            .where((F.col("c") > 1) | (F.size("f.lines") > 1))
            .select("key", F.col("f.id").alias("f_id"), F.col("f.th").alias("f_th"), F.col("f.lines").alias("first")),
            f"firsts{step}")
        if firsts.isEmpty():
            break
        first = F.struct(F.col("f_id").alias("id"), F.col("f_th").alias("th"))
        later = level.join(firsts, "key").where((doc > first) | (F.size("lines") > 1))
        hits = scratch.save(later.groupBy("id", "th", "f_id", "f_th").agg(F.array_sort(F.collect_list(F.struct(
            "lines", "first", "n", "key", "way"))).alias("hits")), f"hits{step}")
        both = (hits.join(once, ["id", "th"])
                .join(once.select(F.col("id").alias("f_id"), F.col("th").alias("f_th"),
                                  F.col("lines").alias("first_lines")), ["f_id", "f_th"]))
        found.append(scratch.save(
            both.select("id", "th", "lines", "first_lines", (doc == first).alias("same"), "hits")
            .mapInArrow(_runs, _FOUND), f"found{step}"))
        level = found[-1].select("id", "th", F.explode("next").alias("m")).select("m.key", "id", "th", "m.lines", "m.n", "m.way")
    runs = reduce(DataFrame.unionAll, found, spark.createDataFrame([], _FOUND)).select("id", "th", "runs") \
        .groupBy("id", "th").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    kept = without(docs, OUTPUT)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col("text").alias("_text"), *key)
    # the same way at every size: texts are dealt by id, never a broadcast that stops fitting
    out = rows.join(scratch.save(runs, "runs").hint("merge"), ["id", "th"], "left").select(
        "_row", _cut.asNondeterministic()("_text", "runs").alias("_cut"))
    return out.select("_row.*", *[F.col(f"_cut.{c}").alias(c) for c in OUTPUT])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that occurred earlier."""
    out = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "removed_lines", "removed_words", "text")
