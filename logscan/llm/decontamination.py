"""Operator 3: benchmark decontamination.

The word n-grams of the benchmark become a broadcast hash set.  Documents are
scanned in Arrow batches: words are cut and hashed over the raw bytes, every
window of n words is looked up by its hash, each hit is verified against the
words themselves, and the words under verified windows are marked.

The broadcast is bounded: benchmarks above ``SLICE_BYTES`` of text are split
by row into slices of about that size.  Each slice is a pass of its own over the
texts, with a broadcast that is given up before the next one; it writes the marks
of the texts it hits to the shared folder, once per text however many copies
there are, and the marks of all passes are united per text.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscan.llm.common import Scratch, hashed_words, read_table, release_memory, text_slices, without, word_class, windows
from logscan.session import ship_package

N_WORDS = 10
SLICE_BYTES = 32 << 20  # benchmark text per broadcast
# separators between words, by contract: ASCII characters but digits and letters
WORD_CLASS = word_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
WORD_CLASS[0x41:0x5B] = True  # A-Z count as a-z
RESULT = "struct<n_words:bigint,spans:array<struct<b:int,e:int>>,items:array<string>,bytes:array<struct<b:int,e:int>>>"


class Grams:
    """Distinct windows of one length: sorted hashes, the words of each, and
    the items that hold it (several windows of one hash are kept apart)."""

    def __init__(self, found: dict[bytes, set[int]], hashes: dict[bytes, int]):
        order = sorted(found, key=lambda g: hashes[g])
        self.hash = np.array([hashes[g] for g in order], dtype=np.uint64)
        self.words = order
        self.items = [sorted(found[g]) for g in order]
        self.seen = np.zeros(1 << 16, dtype=bool)  # first look-up: the top 16 bits
        self.seen[(self.hash >> np.uint64(48)).astype(np.int64)] = True

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Positions in ``h`` whose hash is in the set."""
        at = np.flatnonzero(self.seen[(h >> np.uint64(48)).astype(np.int64)])
        i = np.searchsorted(self.hash, h[at])
        ok = i < len(self.hash)
        ok[ok] = self.hash[i[ok]] == h[at[ok]]
        return at[ok]


def _phrase(words, i: int, n: int) -> bytes:
    return b" ".join(words.data[words.start[j]:words.end[j]].tobytes() for j in range(i, i + n))


def build_index(items: list[tuple[str, str]], n: int = N_WORDS):
    """(item ids, {window length: Grams}) of (id, text) rows."""
    found: dict[int, dict[bytes, set[int]]] = {}
    hashes: dict[bytes, int] = {}
    ids = [i for i, _ in items]
    for first, data, offsets in text_slices(pa.array([t for _, t in items], type=pa.string())):
        words = hashed_words(data, offsets, WORD_CLASS)
        bounds = words.bounds()
        for d in range(words.n_docs):
            lo, hi = bounds[d], bounds[d + 1]
            size = min(n, hi - lo)
            if size == 0:
                continue
            for i, h in enumerate(windows(words.hash[lo:hi], size).tolist()):
                gram = _phrase(words, lo + i, size)
                hashes[gram] = h
                found.setdefault(int(size), {}).setdefault(gram, set()).add(first + d)
    return ids, {size: Grams(g, hashes) for size, g in found.items()}


def scan_slice(data, offsets, ids, index):
    """Per text: word count, marked word spans, items, and their byte spans."""
    words = hashed_words(data, offsets, WORD_CLASS)
    bounds = words.bounds()
    marks = np.zeros(len(words.hash) + 1, dtype=np.int32)
    items: dict[int, set[int]] = {}
    for size, grams in index.items():
        if len(words.hash) < size:
            continue
        at = grams.lookup(windows(words.hash, size))
        at = at[words.doc[at] == words.doc[at + size - 1]]
        for i in at.tolist():
            phrase, h = _phrase(words, i, size), int(windows(words.hash[i:i + size], size)[0])
            j = int(np.searchsorted(grams.hash, np.uint64(h)))
            while j < len(grams.hash) and int(grams.hash[j]) == h:
                if grams.words[j] == phrase:
                    marks[i] += 1
                    marks[i + size] -= 1
                    items.setdefault(int(words.doc[i]), set()).update(grams.items[j])
                j += 1
    hit = np.cumsum(marks[:-1]) > 0
    edge = hit.astype(np.int8)
    begin = np.flatnonzero(np.diff(edge, prepend=0) > 0)
    finish = np.flatnonzero(np.diff(edge, append=0) < 0) + 1
    spans: dict[int, list] = {}
    for b, e in zip(begin.tolist(), finish.tolist()):
        while b < e:  # spans of neighbouring texts may touch: cut them at the border
            d = int(words.doc[b])
            stop = min(e, int(bounds[d + 1]))
            spans.setdefault(d, []).append((b - int(bounds[d]), stop - int(bounds[d]),
                                            int(words.start[b] - offsets[d]), int(words.end[stop - 1] - offsets[d])))
            b = stop
    for d in range(words.n_docs):
        s = spans.get(d, [])
        yield {"n_words": int(bounds[d + 1] - bounds[d]), "spans": [{"b": x[0], "e": x[1]} for x in s],
               "items": [ids[i] for i in items.get(d, ()) if ids[i] is not None],
               "bytes": [{"b": x[2], "e": x[3]} for x in s]}


def _scanner(bc):
    @F.arrow_udf(RESULT)
    def scan(texts: pa.Array) -> pa.Array:
        ids, index = bc.value
        rows = [r for _, data, offsets in text_slices(texts) for r in scan_slice(data, offsets, ids, index)]
        release_memory()
        pair = pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())]))
        return pa.array(rows, type=pa.struct([("n_words", pa.int64()), ("spans", pair),
                                              ("items", pa.list_(pa.string())), ("bytes", pair)]))

    return scan.asNondeterministic()  # keeps the scan in one place of the plan


def benchmark_slices(bench: DataFrame, item_col: str, text_col: str, slice_bytes: int = SLICE_BYTES):
    """Tables of (i: item id, t: text), each of about ``slice_bytes`` of text."""
    rows = bench.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("t is not null")
    rows = rows.dropDuplicates(["i", "t"])  # a repeated row adds nothing, and copies would share a slice
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = max(1, -(-int(size) * 5 // (4 * slice_bytes)))
    return [rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k) for k in range(n)] if n > 1 else [rows]


def _index(part: DataFrame):
    """Broadcast of one slice's index; only this slice's text is on the driver."""
    ship_package(part.sparkSession)
    return part.sparkSession.sparkContext.broadcast(build_index([(r["i"], r["t"]) for r in part.toLocalIterator()]))


TEXT_KEY = ("h1", "h2")


def _text_key(text: str) -> list[Column]:
    """128 bits that name a text: its marks depend on nothing else."""
    return [F.xxhash64(F.lit(k), F.col(text)).alias(h) for k, h in enumerate(TEXT_KEY)]


def _marks_of_slices(texts: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """(h1, h2, spans, items, bytes) of the texts (column ``_text``) that any
    slice hits, united over one pass per slice."""
    scratch, found = Scratch(texts.sparkSession, "leaks"), []
    for part in parts:
        bc = _index(part)
        hit = (texts.select(*_text_key("_text"), _scanner(bc)("_text").alias("s")).where(F.size("s.spans") > 0)
               .groupBy(*TEXT_KEY).agg(F.first("s").alias("s")))
        found.append(scratch.save(hit, f"slice{len(found)}"))
        bc.destroy()
    # at most one row per text and slice
    return (reduce(DataFrame.unionAll, found).groupBy(*TEXT_KEY)
            .agg(*[F.flatten(F.collect_list(f"s.{c}")).alias(c) for c in ("spans", "items", "bytes")]))


def _covered(spans: Column) -> Column:
    """Words under a union of [b, e) spans."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(s["e"] - F.greatest(s["b"], acc["to"]), F.lit(0))).alias("n"),
        F.greatest(acc["to"], s["e"]).alias("to"))
    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc["n"].cast("bigint"))


OUTPUT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_bytes")


def scan_documents(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id",
                   item_text: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """All rows of ``docs`` with n_words, n_hit (words inside an occurrence of
    a benchmark window), n_items and items_sha256 (items with such windows),
    contaminated, and hit_bytes (UTF-8 byte spans of the marked words).

    Null and wordless texts have 0 words and are clean; a benchmark item
    without words is ignored; items of one id count once; an item with a null
    id marks words but is not listed; an empty benchmark leaves all clean.
    Input columns named like an output column are replaced.
    """
    kept = without(docs, OUTPUT)
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(f"`{text_col}`").alias("_text"))
    parts = benchmark_slices(bench, item_col, item_text, slice_bytes)
    if len(parts) == 1:
        marked = out.withColumn("_s", _scanner(_index(parts[0]))("_text"))
    else:
        marks = _marks_of_slices(out, parts)
        empty = docs.sparkSession.sparkContext.broadcast(build_index([]))
        marked = (out.select("_row", *_text_key("_text"), _scanner(empty)("_text")["n_words"].alias("n_words"))
                  .join(marks, list(TEXT_KEY), "left")
                  .select("_row", F.struct("n_words", *[F.coalesce(c, F.array()).alias(c)
                                                        for c in ("spans", "items", "bytes")]).alias("_s")))
    found = marked.select(
        "_row", F.col("_s.n_words").alias("n_words"), _covered(F.col("_s.spans")).alias("n_hit"),
        F.array_sort(F.array_distinct("_s.items")).alias("_items"),
        F.array_sort("_s.bytes").alias("hit_bytes"))
    return found.select(
        "_row.*", "n_words", "n_hit", F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "hit_bytes")


@F.arrow_udf(T.StringType())
def _without_bytes(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, cuts in zip(texts.to_pylist(), spans.to_pylist()):
        if text is not None and cuts:
            raw, kept, at = text.encode(), [], 0
            for c in cuts:
                kept.append(raw[at:max(at, c["b"])])
                at = max(at, c["e"])
            text = (b"".join(kept) + raw[at:]).decode()
        out.append(text)
    return pa.array(out, type=pa.string())


def decontaminate(docs: DataFrame, bench: DataFrame, mode: str = "document", text_col: str = "text") -> DataFrame:
    """Columns of ``docs`` without benchmark text: mode ``document`` drops
    contaminated rows, mode ``span`` cuts the marked words out of the text."""
    if mode not in ("document", "span"):
        raise ValueError(f"mode must be document or span, not {mode!r}")
    found = scan_documents(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                                       F.col(f"`{text_col}`").alias("_body")), bench, "_body")
    if mode == "document":
        return found.where(~F.col("contaminated")).select("_doc.*")
    return found.select(*[_without_bytes("_body", "hit_bytes").alias(c) if c == text_col
                          else F.col("_doc").getField(c).alias(c) for c in docs.columns])


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words, items and verdict of every document."""
    found = scan_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                           read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP3_SQL = """
WITH bw AS (SELECT row_number() OVER () AS r, item_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM benchmark WHERE text IS NOT NULL),
grams AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
          FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM grams),
dw AS (SELECT row_number() OVER () AS r, doc_id,
              coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
occ AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
hits AS (SELECT o.r, o.i, o.n, g.item_id FROM occ o JOIN grams g ON o.n = g.n AND o.g = g.g),
marked AS (SELECT r, count(DISTINCT p) AS n_hit
           FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN marked USING (r) LEFT JOIN named USING (r)
"""
