"""Operator 2: mixing sources to target weights.

The words of a source form one stream, document after document in a
pseudorandom but fixed order, cut into blocks of ``block_words``.  A mix is a
list of slots, one block each, dealt over output shards: the number of slots
each source gets in an output shard is a multinomial draw with the weights of
what the source still has to give, so the draws add up to the targets.  A
source's slots, numbered through all output shards, map to its blocks by one
pseudorandom permutation (a Feistel network) per pass over the source; slots
and blocks then meet in an equi-join on (source, block).

Each pass uses every block once, and a target never exceeds ``max_uses``
times its source, so no document is taken more often than that.  The short
last block of a source comes last in each pass, and a source's final slot is
cut to the words still wanted: totals equal the rounded targets exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscan.llm.common import Scratch, mix, read_table, released, row_hash
from logscan.session import ship_package

WEIGHTS = (3, 1, 2)
SHARE = 1.5          # words of the mix, as a part of all words
MAX_USES = 2
BLOCK_WORDS = 256
MIN_OUT_SHARDS = 64
OUT_SHARD_BLOCKS = 1 << 20
CELL_ROWS = 50_000
MIN_CELLS = 64
SEED = 71
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: list[int], weights, share: float = SHARE, max_uses: float = MAX_USES) -> list[float]:
    """Words per source: ``share`` of all words by weight, each at most
    ``max_uses`` times its size, the excess shared out again by weight."""
    out = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), list(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if weights[i] * unit > max_uses * sizes[i]]
        if not over:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in over:
            out[i] = float(max_uses * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(over)]
    return out


def permute(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of [0, n) under a key, elementwise: a four
    round Feistel network over the next even power of two, walked until the
    value falls below n."""
    x, n, key = i.astype(np.uint64), n.astype(np.uint64), key.astype(np.uint64)
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2).astype(np.float64)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    todo = np.arange(len(x))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = x[todo] >> h, x[todo] & m
        for r in range(4):
            left, right = right, left ^ (mix(right + k + np.uint64(r * 0x9E3779B9)) & m)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= n[todo]]
    return x.astype(np.int64)


@F.arrow_udf(T.LongType())
def _permuted(i: pa.Array, n: pa.Array, key: pa.Array) -> pa.Array:
    return pa.array(permute(*(x.to_numpy(zero_copy_only=False) for x in (i, n, key))))


def draw_counts(slots: list[int], n_shards: int, seed: int = SEED) -> np.ndarray:
    """Slots of each source in each output shard: a multinomial draw per shard
    with the weights of the slots a source still has; what a source cannot
    give is drawn again from the others."""
    rng = np.random.default_rng(seed)
    left = np.array(slots, dtype=np.int64)
    out = np.zeros((n_shards, len(slots)), dtype=np.int64)
    for k in range(n_shards):
        want = -(-int(left.sum()) // (n_shards - k))
        while want:
            got = np.minimum(rng.multinomial(want, left / left.sum()), left)
            out[k] += got
            left -= got
            want -= int(got.sum())
    return out


class Mix:
    """Plan of a mix: ``rows`` (one per document), ``sources`` and ``slots``."""

    def __init__(self, docs: DataFrame, source: str = "source", text: str = "text", keep=(), weights=WEIGHTS,
                 share: float = SHARE, max_uses: int = MAX_USES, block_words: int = BLOCK_WORDS, seed: int = SEED):
        spark = docs.sparkSession
        ship_package(spark)
        self.block = block_words
        scratch = Scratch(spark, "mix")
        base = scratch.save(docs.select(*keep, F.col(source).alias("_source"), word_count(text).alias("size"),
                                        row_hash(docs).alias("_h")), "rows")
        # one row per source: mixing weights are set by source, so the list is configuration-sized
        stats = base.groupBy("_source").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
        stats = sorted(stats, key=lambda r: (r["_source"] is None, r["_source"] or ""))
        sizes = [int(r["n"]) for r in stats]
        goal = targets(sizes, [weights[i % len(weights)] for i in range(len(stats))], share, max_uses)
        plan, n_slots = [], []
        for i, (r, n, t) in enumerate(zip(stats, sizes, goal)):
            words = min(round(t), max_uses * n)
            passes, rest = divmod(words, n) if n else (0, 0)
            blocks = -(-n // block_words)
            n_slots.append(passes * blocks + -(-rest // block_words))
            plan.append((i, r["_source"], n, float(t), blocks, n // block_words, passes, rest))
        self.sources = spark.createDataFrame(
            plan, "_s int, _source string, source_size long, target double, _blocks long, _full long, "
                  "_passes long, _rest long")
        self.rows = self._positions(base, sum(int(r["rows"]) for r in stats))
        self.slots = self._slots(spark, n_slots, seed)

    def _positions(self, base: DataFrame, n_rows: int) -> DataFrame:
        """Each document's first word in its source's stream (``_start``):
        running sums within hash cells of a source plus the words of the
        cells before, so that a hot source is numbered by many tasks."""
        cells = max(MIN_CELLS, n_rows // CELL_ROWS)
        base = (base.withColumn("_cell", F.pmod("_h", F.lit(cells)))
                .join(self.sources.select("_s", "_source", "source_size", "target")
                      .withColumnRenamed("_source", "_name"), F.col("_source").eqNullSafe(F.col("_name")))
                .drop("_name"))
        before = Window.partitionBy("_s").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        firsts = (base.groupBy("_s", "_cell").agg(F.sum("size").alias("_n"))
                  .select("_s", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
        inside = (Window.partitionBy("_s", "_cell").orderBy("_h")
                  .rowsBetween(Window.unboundedPreceding, -1))
        return (base.join(firsts, ["_s", "_cell"])
                .withColumn("_start", F.col("_first") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
                .drop("_cell", "_first"))

    def _slots(self, spark: SparkSession, n_slots: list[int], seed: int) -> DataFrame:
        """out_shard, slot, _s, _block, _use (pass), _take (words of the block)."""
        import pandas as pd  # on the driver only: workers import this module

        total, b = sum(n_slots), self.block
        shards = max(MIN_OUT_SHARDS, -(-total // OUT_SHARD_BLOCKS))
        counts = draw_counts(n_slots, shards, seed) if total else np.zeros((0, len(n_slots)), dtype=np.int64)
        firsts = np.cumsum(counts, axis=0) - counts
        places = np.cumsum(counts, axis=1) - counts
        k, s = np.nonzero(counts)
        runs = spark.createDataFrame(pd.DataFrame({
            "out_shard": k.astype(np.int64), "_s": s.astype(np.int32), "_first": firsts[k, s], "_place": places[k, s],
            "_count": counts[k, s], "_in_shard": counts.sum(axis=1)[k].astype(np.int64)}),
            "out_shard long, _s int, _first long, _place long, _count long, _in_shard long")
        step = 1 << 14
        every = (runs.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_count") - 1, F.lit(step))))
                 .withColumn("_j", F.explode(F.sequence(F.col("_at"), F.least(F.col("_at") + (step - 1),
                                                                            F.col("_count") - 1)))))
        every = every.join(self.sources.drop("_source", "source_size", "target"), "_s")
        i = F.col("_first") + F.col("_j")
        every = every.withColumn("_use", F.expr("(_first + _j) div _blocks")).withColumn("_i", i - F.col("_use") * F.col("_blocks"))
        key = F.xxhash64(F.lit(seed), "_s", "_use").bitwiseAND(F.lit((1 << 62) - 1))
        place = F.xxhash64(F.lit(seed), "out_shard").bitwiseAND(F.lit((1 << 62) - 1))
        last = (F.col("_use") == F.col("_passes")) & ((F.col("_i") + 1) * b >= F.col("_rest"))
        return every.select(
            "out_shard", _permuted(F.col("_place") + F.col("_j"), F.col("_in_shard"), place).alias("slot"), "_s", "_use",
            F.when(F.col("_i") < F.col("_full"), _permuted(F.least(F.col("_i"), F.greatest(F.col("_full") - 1, F.lit(0))),
                                                           F.greatest(F.col("_full"), F.lit(1)), key))
            .otherwise(F.col("_i")).alias("_block"),
            F.when(last, F.col("_rest") - F.col("_i") * b).otherwise(F.lit(b)).alias("_take"))

    def pieces(self) -> DataFrame:
        """Each document's words in each slot that takes some (outer: a
        document without taken words has one row with null _use): columns of
        ``rows`` plus out_shard, slot, _use and words [_from, _to) of the document."""
        b = self.block
        parts = (self.rows.where("size > 0")
                 .withColumn("_block", F.explode(F.expr(f"sequence(_start div {b}, (_start + size - 1) div {b})"))))
        both = parts.join(self.slots, ["_s", "_block"], "left")
        lo = F.greatest(F.col("_start"), F.col("_block") * b)
        hi = F.least(F.col("_start") + F.col("size"), F.col("_block") * b + F.col("_take"))
        return (both.withColumn("_from", lo - F.col("_start"))
                .withColumn("_to", F.when(F.col("_use").isNull(), F.col("_from"))
                            .otherwise(F.greatest(hi - F.col("_start"), F.col("_from")))))


def mix_counts(docs: DataFrame, keep=("doc_id",), **options) -> DataFrame:
    """One row per document: ``keep`` columns, size, source_size, target, taken.

    A null source is a source of its own (the last); a null or wordless text
    has size 0 and taken 0; rows equal in every column are separate rows of
    the stream and may be taken differently; an empty table gives no rows.
    """
    plan = Mix(docs, keep=keep, **options)
    cols = [*keep, "size", "source_size", "target"]
    taken = (plan.pieces().groupBy("_s", "_start")
             .agg(*[F.first(c).alias(c) for c in cols],
                  F.sum(F.coalesce(F.col("_to") - F.col("_from"), F.lit(0))).cast("bigint").alias("taken")))
    empty = plan.rows.where("size = 0").select(*cols, F.lit(0).cast("bigint").alias("taken"))
    return taken.select(*cols, "taken").unionByName(empty)


_WORD = regex.compile(WORD)


def cut_words(text: str, ranges: list[tuple[int, int]], n_words: int) -> str:
    """Words [a, b) of a text for each range, in order, with their original
    spacing; the text itself when one range covers all its words."""
    if ranges == [(0, n_words)]:
        return text
    spans = [m.span() for m in _WORD.finditer(text)]
    return "\n".join(text[spans[a][0]:spans[b - 1][1]] for a, b in ranges)


def _merged(pieces) -> dict[int, list[tuple[int, int]]]:
    """Joined word ranges per pass."""
    out: dict[int, list[tuple[int, int]]] = {}
    for use, a, b in sorted(pieces):
        runs = out.setdefault(use, [])
        if runs and runs[-1][1] == a:
            runs[-1] = (runs[-1][0], b)
        else:
            runs.append((a, b))
    return out


def _cut_rows(place: int):
    """Merge of a partition sorted by (_h, _kind): a document's piece lists
    (kind 0) precede its rows (kind 1), each of which takes one list.  A row's
    columns are in one struct; its field ``place`` is the text."""
    def run(batches):
        h_now, waiting = None, []
        for batch in batches:
            names = batch.schema.names
            hs = batch.column(names.index("_h")).to_numpy(zero_copy_only=False)
            kinds = batch.column(names.index("_kind")).to_numpy(zero_copy_only=False)
            lists = batch.column(names.index("_pieces"))
            sizes = batch.column(names.index("_size"))
            rows = batch.column(names.index("_row"))
            texts = rows.field(place)
            take, cut = [], []
            for r in range(len(hs)):
                if hs[r] != h_now:
                    h_now, waiting = hs[r], []
                if kinds[r] == 0:
                    waiting.append((sizes[r].as_py(), lists[r].as_py()))
                elif waiting:
                    n, pieces = waiting.pop()
                    triples = [(p["_use"], p["_from"], p["_to"]) for p in pieces]
                    for _, ranges in sorted(_merged(triples).items()):
                        take.append(r)
                        cut.append(cut_words(texts[r].as_py(), ranges, n))
            if take:
                kept = rows.take(pa.array(take)).flatten()
                kept[place] = pa.array(cut, type=kept[place].type)
                yield pa.RecordBatch.from_arrays(kept, [rows.type.field(i).name for i in range(len(kept))])

    return run


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix as rows of ``docs``: one row per document and pass that takes
    words of it, its text cut to the taken words (unchanged when all are
    taken; separate ranges are joined by a line feed).

    Documents without taken words (also null and wordless texts) have no row.
    Columns keep their names, whatever they are.
    """
    plan = Mix(docs, text=text, **options)
    wanted = (plan.pieces().where("_to > _from").groupBy("_s", "_start")
              .agg(F.first("_h").alias("_h"), F.first("size").alias("_size"),
                   F.collect_list(F.struct("_use", "_from", "_to")).alias("_pieces")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), row_hash(docs).alias("_h"))
    lists = wanted.select("_h", F.lit(0).alias("_kind"), "_pieces", "_size",
                          F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"))
    rows = rows.select("_h", F.lit(1).alias("_kind"),
                       F.lit(None).cast(wanted.schema["_pieces"].dataType).alias("_pieces"),
                       F.lit(None).cast("long").alias("_size"), "_row")
    both = lists.unionByName(rows).repartition(F.col("_h")).sortWithinPartitions("_h", "_kind")
    return both.mapInArrow(released(_cut_rows(docs.columns.index(text))), docs.schema)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default mix over all documents: words taken of each."""
    return mix_counts(read_table(spark, sf_dir, "documents"))
