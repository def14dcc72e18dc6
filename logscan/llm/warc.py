"""Operator 10: Merkle fixity audit of WARC replicas.

Records of an archive file are hashed whole and combined into a tree over
ordered offset ranges: 64 KiB of offsets, then 16 ranges to a node, up to the
file, then 16 files to a node, up to one root.  Two replicas are compared
from the root down; each level joins only the children of nodes that differ,
so an intact branch is never opened.  The records below the last differing
ranges are the damage: changed, missing or extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logscan.llm.common import Scratch, read_table

FILE_IDS = 1000        # consecutive page ids per archive file
ID_CELL, NO_ID_CELL = 3, 6  # hex digits of the hash that cut a file into cells: pages with an id, without
COPIES = 4096          # equal records numbered by one row
RANGE_BITS = 16        # a leaf range: 64 KiB of offsets
NODE_BITS = 4          # 16 children per node


def warc_records(pages: DataFrame) -> DataFrame:
    """One response record per page: page_id, url, record.

    A null url or html is rendered as the empty text, a missing id as "none".
    Other columns of ``pages``, whatever their names, play no part.
    """
    url, html = (F.coalesce(F.col(c), F.lit("")) for c in ("url", "html"))
    page_id = F.col("page_id").cast("bigint")
    record = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
                      F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">\r\nWARC-Target-URI: "), url,
                      F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html,
                      F.lit("\r\n\r\n"))
    return pages.select(page_id.alias("page_id"), "url", record.alias("record"))


def _sha(record: Column) -> Column:
    return F.sha2(record.cast("binary"), 256)


def record_index(records: DataFrame, replica: Column | None = None) -> DataFrame:
    """file, offset, length, page_id, url and hash of every record, and
    replica_hash: that of the record ``replica`` names in its place (null: none).

    A file holds the pages of ``FILE_IDS`` consecutive ids in the order of id
    and hash; a page without an id goes to one of 4096 files numbered below
    zero by its hash.  Equal records are records of their own.  Texts are
    read and hashed once; only the narrow rows are shuffled.  Equal ones are
    counted before that, and offsets are running sums inside hash cells of a
    file plus the bytes of the cells before, so that neither copies nor an id
    with many records put a file into one task.
    """
    no_id = F.col("page_id").isNull()
    measured = records.select("page_id", "url", F.octet_length("record").cast("bigint").alias("length"),
                              _sha(F.col("record")).alias("hash"),
                              _sha(F.lit(None).cast("string") if replica is None else replica).alias("replica_hash"))
    file = F.when(no_id, -F.conv(F.substring("hash", 1, 3), 16, 10).cast("bigint") - 1).otherwise(
        F.floor(F.col("page_id") / FILE_IDS).cast("bigint"))
    cell = F.when(no_id, F.substring("hash", 1, NO_ID_CELL)).otherwise(F.substring("hash", 1, ID_CELL))
    key = ["file", "page_id", "_cell", "hash"]
    kinds = (measured.select(file.alias("file"), cell.alias("_cell"), "*")
             .groupBy(*key, "url", "length", "replica_hash").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_bytes", F.col("_n") * F.col("length")))
    kinds = Scratch(records.sparkSession, "records").save(kinds, "kinds")
    before = Window.partitionBy("file").orderBy("page_id", "_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (kinds.groupBy("file", "page_id", "_cell").agg(F.sum("_bytes").alias("_bytes"))
             .select(F.col("file").alias("_file"), F.col("page_id").alias("_page"), F.col("_cell").alias("_in"),
                     F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_first")))
    inside = (Window.partitionBy("file", "page_id", "_cell").orderBy("hash", "url", "replica_hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (kinds.withColumn("_start", F.coalesce(F.sum("_bytes").over(inside), F.lit(0)))
              .join(cells, (F.col("file") == F.col("_file")) & F.col("page_id").eqNullSafe(F.col("_page"))
                    & (F.col("_cell") == F.col("_in")))
              .withColumn("_start", F.col("_start") + F.col("_first")))
    runs = (placed.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(COPIES).cast("bigint"))))
            .repartition("hash", "_from"))
    each = F.explode(F.sequence("_from", F.least(F.col("_from") + COPIES, F.col("_n")) - 1))
    return runs.withColumn("_i", each).select(
        "file", (F.col("_start") + F.col("_i") * F.col("length")).alias("offset"), "length", "page_id", "url", "hash",
        "replica_hash")


def record_hashes(records: DataFrame) -> DataFrame:
    """Leaves of the tree: file, offset and the record's hash."""
    return record_index(records).select("file", "offset", "hash")


def _combined(child: str) -> Column:
    """Hash of the children's numbers and hashes, in order."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(child).alias("n"), F.col("hash").alias("h"))))
    return F.sha2(F.array_join(F.transform(pairs, lambda p: F.concat_ws(":", p["n"], p["h"])), ",").cast("binary"), 256)


class Tree:
    """Levels of one replica, leaves first: tables with file, node and hash.
    ``heights`` is (offset levels, file levels), equal for replicas that are
    compared."""

    def __init__(self, leaves: DataFrame, heights: tuple[int, int], scratch: Scratch, name: str):
        self.levels = [leaves.withColumnRenamed("offset", "node")]
        in_file, over_files = heights
        for k in range(1, in_file + over_files + 2):
            below = self.levels[-1]
            file, node, child = self.parent(k, in_file, over_files)
            up = (below.select(file.alias("file"), node.alias("up"), F.col(child).alias("child"), "hash")
                  .groupBy("file", "up").agg(_combined("child").alias("hash"))
                  .withColumnRenamed("up", "node"))
            self.levels.append(scratch.save(up, f"{name}-{k}"))

    @staticmethod
    def parent(level: int, in_file: int, over_files: int):
        """File and node of the parent at ``level`` of a row one level below,
        and the column that numbers the row among its siblings."""
        zero = F.lit(0).cast("bigint")
        if level <= in_file:
            return F.col("file"), F.shiftright("node", RANGE_BITS if level == 1 else NODE_BITS), "node"
        if level <= in_file + over_files:
            return F.shiftright("file", NODE_BITS), zero, "file"
        return zero, zero, "file"


def tree_heights(*leaves: DataFrame) -> tuple[int, int]:
    """Levels needed so that a file has one node and few files share the root."""
    top, low, high = 0, 0, 0
    for t in leaves:
        r = t.agg(F.max("offset"), F.min("file"), F.max("file")).first()
        if r[0] is not None:
            top, low, high = max(top, r[0]), min(low, r[1]), max(high, r[2])
    in_file = 1
    while top >> (RANGE_BITS + NODE_BITS * (in_file - 1)):
        in_file += 1
    over = 0
    while high >> (NODE_BITS * over) > 15 or -low >> (NODE_BITS * over) > 15:
        over += 1
    return in_file, over


def compare_replicas(a: DataFrame, b: DataFrame) -> DataFrame:
    """file, offset, status (changed, missing, extra) and both hashes of the
    records in which replica ``b`` differs from ``a`` (leaf tables of
    ``record_hashes``).  Equal roots end the audit with no rows."""
    scratch = Scratch(a.sparkSession, "fixity")
    a, b = scratch.save(a, "a-0"), scratch.save(b, "b-0")
    heights = tree_heights(a, b)
    ta, tb = Tree(a, heights, scratch, "a"), Tree(b, heights, scratch, "b")

    def differing(level: int, within: DataFrame | None) -> DataFrame:
        sides = []
        for tree, name in ((ta, "hash_a"), (tb, "hash_b")):
            rows = tree.levels[level]
            if within is not None:
                file, node, _ = Tree.parent(level + 1, *heights)
                rows = (rows.withColumn("_f", file).withColumn("_n", node)
                        .join(within.select(F.col("file").alias("_f"), F.col("node").alias("_n")), ["_f", "_n"], "left_semi"))
            sides.append(rows.select("file", "node", F.col("hash").alias(name)))
        # equal (file, node) on one side twice would be equal leaves: node is an offset
        return (sides[0].join(sides[1], ["file", "node"], "full")
                .where(~F.col("hash_a").eqNullSafe(F.col("hash_b"))))

    found = scratch.save(differing(len(ta.levels) - 1, None), "differs-root")
    for level in range(len(ta.levels) - 2, -1, -1):
        found = scratch.save(differing(level, found), f"differs-{level}")
    status = (F.when(F.col("hash_b").isNull(), "missing").when(F.col("hash_a").isNull(), "extra").otherwise("changed"))
    return found.select("file", F.col("node").alias("offset"), status.alias("status"), "hash_a", "hash_b")


def damaged() -> Column:
    """A replica's record with damage by rule, for the registered query: where
    the md5 of the id starts with 00 its first byte is overwritten, with 01 it
    is lost.  Offsets stay those of the index."""
    mark = F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit("none")).cast("binary")), 1, 2)
    return (F.when(mark == "00", F.concat(F.lit("#"), F.substring("record", 2, 1 << 30)))
            .when(mark != "01", F.col("record")))


def op10_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged records of the replica of all pages."""
    scratch = Scratch(spark, "archive")
    index = scratch.save(record_index(warc_records(read_table(spark, sf_dir, "pages")), damaged()), "index")
    bad = compare_replicas(index.select("file", "offset", "hash"),
                           index.where("replica_hash is not null").select("file", "offset", F.col("replica_hash").alias("hash")))
    return bad.join(index.drop("hash", "replica_hash"), ["file", "offset"]).select(
        "file", "offset", "length", "page_id", "url", "status", "hash_a", "hash_b")


OP10_SQL = """
WITH p AS (SELECT page_id, url,
                  'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
                  || coalesce(CAST(page_id AS VARCHAR), 'none') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: '
                  || coalesce(url, '') || chr(13) || chr(10)
                  || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
                  || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM pages),
r AS (SELECT *, sha256(record) AS hash, left(md5(coalesce(CAST(page_id AS VARCHAR), 'none')), 2) AS mark,
             CASE WHEN page_id IS NULL THEN -CAST('0x' || left(sha256(record), 3) AS BIGINT) - 1
                  ELSE CAST(floor(page_id / 1000) AS BIGINT) END AS file FROM p),
o AS (SELECT *, CAST(strlen(record) AS BIGINT) AS length,
             CAST(coalesce(sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id, hash, url
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM r)
SELECT file, "offset", length, page_id, url, CASE WHEN mark = '01' THEN 'missing' ELSE 'changed' END AS status,
       hash AS hash_a, CASE WHEN mark = '00' THEN sha256('#' || substr(record, 2)) END AS hash_b
FROM o WHERE mark IN ('00', '01')
"""
