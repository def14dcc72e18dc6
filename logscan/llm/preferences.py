"""Operator 5: preference formatting (native).

A preference pair is a chosen and a rejected conversation.  The turns they
share from the start are found by comparing the two turn lists position by
position; that longest common prefix is rendered once as the prompt, and the
rest of each side is rendered as its completion together with the character
spans that a loss applies to (the assistant's words and end marks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logscan.llm.common import read_table

START, END = "<|im_start|>", "<|im_end|>"
SPANS = "array<struct<start:int,end:int>>"


def turn_lists(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, turns): the turns of each conversation in order.

    Ordered by turn, then role, then text, so that repeated turn numbers have
    a fixed order; a null role becomes ``unknown``, a null text the empty
    text; ``<|`` inside a text is spaced out so that it cannot pose as a mark.
    Rows without a conversation id belong to none and are left out.
    """
    item = F.struct("turn", "role", "text")
    clean = lambda t: F.struct(
        F.coalesce(t["role"], F.lit("unknown")).alias("role"),
        F.replace(F.coalesce(t["text"], F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"))
    return (turns.where(F.col(conv).isNotNull()).groupBy(F.col(conv).alias("conv_id"))
            .agg(F.transform(F.array_sort(F.collect_list(item)), clean).alias("turns")))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that two turn lists share."""
    same = F.zip_with(a, b, lambda x, y: (x["role"].eqNullSafe(y["role"])) & (x["text"].eqNullSafe(y["text"])))
    first_other = F.array_position(same, F.lit(False))
    return F.when(first_other == 0, F.size(same)).otherwise(first_other - 1).cast("int")


def _head(t) -> Column:
    return F.concat(F.lit(START), t["role"], F.lit("\n"))


def _render(t) -> Column:
    return F.concat(_head(t), t["text"], F.lit(END + "\n"))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def _loss_spans(turns: Column) -> Column:
    """[start, end) characters of the assistant's words and end marks."""
    def step(acc, t):
        start = acc["at"] + F.length(_head(t))
        end = start + F.length(t["text"]) + F.lit(len(END))
        span = F.array(F.struct(start.cast("int").alias("start"), end.cast("int").alias("end")))
        return F.struct((end + 1).cast("int").alias("at"),
                        F.when(t["role"] == "assistant", F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    return F.aggregate(turns, zero, step, lambda acc: acc["spans"])


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Adds to rows with two turn lists: prompt_turns, prompt, the two
    completions (``<side>_completion``) and their loss spans
    (``<side>_spans``), and identical (no turn differs; both completions are
    empty then).  No common turn gives an empty prompt."""
    a, b = F.col(chosen), F.col(rejected)
    out = pairs.withColumn("prompt_turns", common_prefix(a, b))
    rest = {s: F.slice(F.col(s), F.col("prompt_turns") + 1, F.greatest(F.size(s) - F.col("prompt_turns"), F.lit(0)))
            for s in (chosen, rejected)}
    out = out.withColumn("prompt", _text(F.slice(a, F.lit(1), F.col("prompt_turns"))))
    for s in (chosen, rejected):
        out = out.withColumn(f"{s}_completion", _text(rest[s])).withColumn(f"{s}_spans", _loss_spans(rest[s]))
    return out.withColumn("identical", (F.size(a) == F.col("prompt_turns")) & (F.size(b) == F.col("prompt_turns")))


RING_SIZE = 512  # conversations that pass replies around among themselves


def _hash(salt: int) -> Column:
    """60 bits of the MD5 of salt and conversation id: the same in any engine."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), F.col("conv_id").cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def branch_pairs(turns: DataFrame) -> DataFrame:
    """One pair for every conversation, with all its turns: chosen is the whole
    conversation; rejected leaves it at one of its assistant turns (picked by a
    hash of the id) and goes on with another conversation's turns from one of
    that one's assistant turns on.

    Conversations with an assistant turn are dealt by hash into rings of about
    ``RING_SIZE`` and each gives its turns to the next one of its ring; one
    that is alone in its ring takes them from the smallest (or, if it is that,
    the largest) id that has some.  A conversation without an assistant turn,
    or with no other to take from, has an empty rejected side.
    """
    lists = turn_lists(turns)
    at = F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1)), lambda i: i.isNotNull())
    lists = lists.withColumn("_at", at).withColumn(
        "_branch", F.when(F.size("_at") > 0, F.get("_at", (_hash(0) % F.size("_at")).cast("int"))))
    ids = turns.where(F.col("conv_id").isNotNull() & (F.col("role") == "assistant")).select("conv_id").distinct()
    ends = ids.agg(F.count(F.lit(1)).alias("_n"), F.min("conv_id").alias("_min"), F.max("conv_id").alias("_max"))
    dealt = ids.crossJoin(F.broadcast(ends)).withColumn("_h", _hash(1))
    dealt = dealt.withColumn("_ring", F.col("_h") % F.greatest(F.lit(1), F.ceil(F.col("_n") / RING_SIZE)))
    ring = Window.partitionBy("_ring").orderBy("_h", "conv_id")
    giver = F.coalesce(F.lag("conv_id").over(ring), F.last("conv_id").over(ring.rowsBetween(0, Window.unboundedFollowing)))
    taken = dealt.select("conv_id", giver.alias("_from"), "_min", "_max").withColumn(
        "_from", F.when(F.col("_from") != F.col("conv_id"), F.col("_from"))
        .when(F.col("_min") != F.col("conv_id"), F.col("_min"))
        .when(F.col("_max") != F.col("conv_id"), F.col("_max")))
    tails = lists.where(F.col("_branch").isNotNull()).select(
        F.col("conv_id").alias("_from"), F.slice("turns", F.col("_branch"), F.size("turns")).alias("_tail"))
    tails = taken.select("conv_id", "_from").join(tails, "_from").select("conv_id", "_tail")
    return lists.join(tails, "conv_id", "left").select(
        "conv_id", F.col("turns").alias("chosen"),
        F.when(F.col("_tail").isNull(), F.slice("turns", F.lit(1), F.lit(0)))
        .otherwise(F.concat(F.slice("turns", F.lit(1), F.col("_branch") - 1), "_tail")).alias("rejected"))


def _mask(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")


def _rows(out: DataFrame) -> DataFrame:
    """The columns of the queries; loss spans as text."""
    return out.select("conv_id", "prompt_turns", "prompt", "chosen_completion", "rejected_completion",
                      _mask("chosen_spans").alias("chosen_mask"), _mask("rejected_spans").alias("rejected_mask"),
                      "identical")


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A formatted pair of every conversation with all its turns."""
    return _rows(format_pairs(branch_pairs(read_table(spark, sf_dir, "conversations"))))


OP5_SQL = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
                                              text NULLS FIRST) AS p,
                  coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT conv_id, max(p) AS last, list(p ORDER BY p) FILTER (WHERE role = 'assistant') AS spots,
             CAST('0x' || substr(md5('0:' || conv_id), 1, 15) AS BIGINT) AS h0,
             CAST('0x' || substr(md5('1:' || conv_id), 1, 15) AS BIGINT) AS h1 FROM t GROUP BY conv_id),
b AS (SELECT conv_id, spots[h0 % len(spots) + 1] AS branch, h1, min(conv_id) OVER () AS low, max(conv_id) OVER () AS high,
             h1 % greatest(1, CAST(ceil(count(*) OVER () / 512.0) AS BIGINT)) AS ring FROM h WHERE len(spots) > 0),
g AS (SELECT *, coalesce(lag(conv_id) OVER (PARTITION BY ring ORDER BY h1, conv_id),
                         last_value(conv_id) OVER (PARTITION BY ring ORDER BY h1, conv_id
                                                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS f FROM b),
q AS (SELECT conv_id, branch, CASE WHEN f <> conv_id THEN f WHEN low <> conv_id THEN low
                                   WHEN high <> conv_id THEN high END AS giver FROM g),
side AS (SELECT 'c' AS side, conv_id, p, role, text FROM t
         UNION ALL SELECT 'r', t.conv_id, p, role, text FROM t JOIN q USING (conv_id) WHERE giver IS NOT NULL AND p < branch
         UNION ALL SELECT 'r', q.conv_id, q.branch + p - o.branch, role, text
                   FROM q JOIN q o ON o.conv_id = q.giver JOIN t ON t.conv_id = o.conv_id AND p >= o.branch),
d AS (SELECT coalesce(c.conv_id, j.conv_id) AS conv_id, min(coalesce(c.p, j.p)) AS p
      FROM (SELECT * FROM side WHERE side = 'c') c FULL JOIN (SELECT * FROM side WHERE side = 'r') j
        ON j.conv_id = c.conv_id AND j.p = c.p
      WHERE c.p IS NULL OR j.p IS NULL OR c.role <> j.role OR c.text <> j.text GROUP BY 1),
l AS (SELECT h.conv_id, h.last, coalesce(d.p - 1, h.last) AS k, d.p IS NULL AS same FROM h LEFT JOIN d USING (conv_id)),
r AS (SELECT side, s.conv_id, p, k, role, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS x,
             length(role) + 13 AS head, length(text) + 10 AS body FROM side s JOIN l USING (conv_id)),
o AS (SELECT *, coalesce(sum(length(x)) OVER (PARTITION BY side, conv_id ORDER BY p
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins FROM r WHERE p > k),
f AS (SELECT side, conv_id, string_agg(x, '' ORDER BY p) AS x,
             string_agg(CAST(begins + head AS BIGINT) || '-' || CAST(begins + head + body AS BIGINT), ',' ORDER BY p)
               FILTER (WHERE role = 'assistant') AS m FROM o GROUP BY side, conv_id)
SELECT l.conv_id, CAST(l.k AS INTEGER) AS prompt_turns,
       coalesce((SELECT string_agg(x, '' ORDER BY p) FROM r WHERE side = 'c' AND r.conv_id = l.conv_id AND p <= r.k), '') AS prompt,
       coalesce(c.x, '') AS chosen_completion, coalesce(j.x, '') AS rejected_completion,
       coalesce(c.m, '') AS chosen_mask, coalesce(j.m, '') AS rejected_mask, l.same AS identical
FROM l LEFT JOIN f c ON c.side = 'c' AND c.conv_id = l.conv_id LEFT JOIN f j ON j.side = 'r' AND j.conv_id = l.conv_id
"""
