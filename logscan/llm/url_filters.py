"""Operator 12: URL filters by pattern rules indexed by their rarest literal token.

A rule is a site rule (``host/path``: the host and all its subdomains, paths
that start with the rule's) or a pattern over the whole url:

* ``||`` at the start: the start of the host or of a part of it after a dot,
* ``|`` at the start or end: the start or end of the url,
* ``^``: one character that is no letter or digit, or the start or end,
* ``*``: any run of characters; anything else stands for itself.

Every rule becomes a regular expression and the list of its literal tokens:
runs of letters and digits that, wherever the rule fits, stand whole in the
url.  The rule is indexed by the token that is rarest over all urls (exact
counts).  A url looks up its own tokens and runs the expressions of the rules
found there only, and those of rules without such a token.

Rules up to ``BROADCAST_RULES`` rows and ``BROADCAST_BYTES`` bytes (both
measured) are broadcast, and only the url column enters Python.  Beyond it
tokens and rules meet in a shuffled join, salted so that a token that most
urls hold is spread over ``SALT`` tasks.

Verdict: of the site rules that fit, the longest decides (ties: the longer
host, then the smaller text).  Without one, a fitting allow pattern allows, a
fitting block pattern blocks, and any other url is allowed.

Nulls and odd input: a null url, or one without ``://``, has an empty host and
path and no site rule fits it; patterns see a null url as an empty one.  Only
A-Z are lower-cased: in hosts, patterns and what patterns see; paths of site
rules keep their case.  Rules that are null or empty fit nothing.  A rule
given as both allow and block allows.  Input columns named like an output
column are replaced; all others are kept, and so is every row.
"""

from __future__ import annotations

import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscan.llm.common import Scratch, read_table, without
from logscan.session import ship_package

BROADCAST_RULES = 250_000
BROADCAST_BYTES = 16 << 20
SALT = 32

# Fixed values (of the task): site rules of the registered query.
SITE_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
              ("net/es/", "block"), ("net/fr/", "block")]
# Pattern rules for urls that no site rule fits: advertising, gambling, adult
# and spam names, and two exceptions.
PATTERN_RULES = [(p, "block") for p in (
    "^casino^", "^poker^", "^betting^", "^porn^", "^xxx^", "^viagra^", "^pills^", "^spam^", "^warez^", "^torrent^",
    "||ads.", "||adserver.", "/popunder", "*/banners/*.gif|")] + [
    (p, "allow") for p in ("^anti^spam^", "||library.*^betting^")]
RULES_SCHEMA = "rule string, kind string, action string"
OUTPUT = ("host", "path", "rule", "pattern", "n_run", "verdict")

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_TOKEN = re.compile(r"[a-z0-9\x80-\U0010ffff]+")
_EDGE = r"(?:\A|\Z|[^a-z0-9\x80-\U0010ffff])"
_SITE = re.compile(r"://([^/?#]*)([^?#]*)")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) of a url; both empty without ``://``."""
    m = _SITE.search(url or "")
    return (m[1].translate(_UPPER), m[2]) if m else ("", "")


def tokens_of(url: str | None) -> set[str]:
    return set(_TOKEN.findall((url or "").translate(_UPPER)))


def _whole_tokens(text: str, open_start: bool, open_end: bool) -> list[str]:
    """Runs of letters and digits that no run of a fitting url can extend:
    not next to a ``*``, nor at an open end of the rule."""
    out = []
    for m in _TOKEN.finditer(text):
        left = open_start if m.start() == 0 else text[m.start() - 1] == "*"
        right = open_end if m.end() == len(text) else text[m.end()] == "*"
        if not left and not right:
            out.append(m[0])
    return out


def compile_site(rule: str) -> tuple[str, list[str]]:
    """(expression over host + path, literal tokens) of a site rule."""
    host, slash, path = rule.partition("/")
    host, path = host.translate(_UPPER), slash + path
    lead = rf"\A(?:[^/]*\.)?{re.escape(host)}" if host else r"\A[^/]*"
    tokens = _TOKEN.findall(host) + _whole_tokens(path.translate(_UPPER), False, True)
    return lead + (re.escape(path) if path else r"(?:/|\Z)"), tokens


def compile_pattern(rule: str) -> tuple[str, list[str]]:
    """(expression over the lower-cased url, literal tokens) of a pattern."""
    body, lead, tail = rule.translate(_UPPER), "", ""
    if body.startswith("||"):
        body, lead = body[2:], r"\A[^/?#]*?://(?:[^/?#]*\.)?"
    elif body.startswith("|"):
        body, lead = body[1:], r"\A"
    if body.endswith("|"):
        body, tail = body[:-1], r"\Z"
    middle = "".join(".*" if c == "*" else _EDGE if c == "^" else re.escape(c) for c in body)
    return lead + middle + tail, _whole_tokens(body, not lead, not tail)


def compile_rule(rule: str, kind: str) -> tuple[str, list[str]]:
    return compile_site(rule) if kind == "site" else compile_pattern(rule)


def fits(expression: re.Pattern, kind: str, url: str, host: str, path: str) -> bool:
    return bool(expression.match(host + path) if kind == "site" and "://" in url
                else kind == "pattern" and expression.search(url.translate(_UPPER)))


def site_rank(rule: str):
    """Sort key of fitting site rules: the first one decides."""
    return -len(rule), -len(rule.partition("/")[0]), rule


class RuleIndex:
    """Rules under their rarest token; ``judge`` runs only those a url fetches."""

    def __init__(self, rules, counts: dict[str, int]):
        self.by_token, self.always = defaultdict(list), []
        for rule, kind, action in rules:
            expression, tokens = compile_rule(rule, kind)
            entry = [expression, rule, kind, action]
            if tokens:
                self.by_token[min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t))].append(entry)
            else:
                self.always.append(entry)
        self.by_token = dict(self.by_token)

    def judge(self, url: str | None):
        """(host, path, site rule, pattern, expressions run, verdict)."""
        url = url or ""
        host, path = split_url(url)
        found, n_run = [], 0
        for entries in [self.always, *(self.by_token[t] for t in tokens_of(url) if t in self.by_token)]:
            for entry in entries:
                if isinstance(entry[0], str):
                    entry[0] = re.compile(entry[0], re.DOTALL)  # on first use
                n_run += 1
                if fits(entry[0], entry[2], url, host, path):
                    found.append(entry[1:])
        return (host, path, *decide(found), n_run)


def decide(found) -> tuple[str | None, str | None, str]:
    """(site rule, pattern, verdict) from the (rule, kind, action) that fit."""
    sites = sorted((site_rank(r), r, a) for r, k, a in found if k == "site")
    patterns = sorted((a != "allow", -len(r), r, a) for r, k, a in found if k == "pattern")
    site, pattern = (sites[0] if sites else None), (patterns[0] if patterns else None)
    return (site and site[1], pattern and pattern[2],
            site[2] if site else pattern[3] if pattern else "allow")


_NAMES = ("host", "path", "rule", "pattern", "verdict", "n_run")
_STRUCT = pa.struct([(n, pa.int32() if n == "n_run" else pa.string()) for n in _NAMES])
_RESULT = T.StructType([T.StructField(n, T.IntegerType() if n == "n_run" else T.StringType()) for n in _NAMES])


def token_counts(urls: DataFrame, wanted) -> DataFrame:
    """(token, n): how many rows of ``urls`` hold each token that ``wanted``
    (a broadcast set, or None for all) names; counted per partition first."""

    def count(batches):
        n = defaultdict(int)
        for batch in batches:
            for url in batch.column("url").to_pylist():
                for t in tokens_of(url):
                    if wanted is None or t in wanted.value:
                        n[t] += 1
            if len(n) > 1 << 18:  # a sub-total: the sum below adds them up
                yield _counts(n)
                n.clear()
        if n:
            yield _counts(n)

    return urls.mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _counts(n: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())],
                                      ["token", "n"])


def clean_rules(rules: DataFrame) -> DataFrame:
    """One row per rule text and kind; allow wins over block."""
    return (rules.select("rule", "kind", F.lower("action").alias("action"))
            .where("length(rule) > 0 AND kind IN ('site', 'pattern') AND action IN ('allow', 'block')")
            .groupBy("rule", "kind").agg(F.min("action").alias("action")))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", broadcast_rules: int = BROADCAST_RULES,
               broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` with host, path, the deciding site ``rule``, the strongest
    fitting ``pattern``, ``n_run`` (expressions run) and the ``verdict``.

    ``rules`` has the columns rule, kind (site or pattern) and action (allow
    or block).
    """
    spark = pages.sparkSession
    ship_package(spark)
    rules = clean_rules(rules)
    n, size = rules.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("rule")), F.lit(0))).first()
    if n > broadcast_rules or size > broadcast_bytes:
        return _judge_joined(pages, rules, url)
    own = [tuple(r) for r in rules.orderBy("kind", "rule").collect()]  # at most broadcast_bytes of text
    wanted = spark.sparkContext.broadcast({t for r, k, _ in own for t in compile_rule(r, k)[1]})
    counts = {r["token"]: r["n"] for r in token_counts(pages.select(F.col(url).alias("url")), wanted).collect()}
    index = spark.sparkContext.broadcast(RuleIndex(own, counts))

    @F.arrow_udf(_RESULT)
    def judged(urls: pa.Array) -> pa.Array:
        rows = [index.value.judge(u) for u in urls.to_pylist()]
        return pa.StructArray.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _STRUCT)]
                                          if rows else [pa.array([], t.type) for t in _STRUCT], fields=list(_STRUCT))

    keep = without(pages, (*OUTPUT, "_judged"))
    return (pages.withColumn("_judged", judged(F.col(url)))
            .select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"_judged.{c}").alias(c) for c in OUTPUT]))


def _compiled(batches):
    """(rule, kind, action, token) rows, one per literal token, '' for none."""
    for batch in batches:
        rows = [(r, k, a, t) for r, k, a in zip(*(batch.column(c).to_pylist() for c in ("rule", "kind", "action")))
                for t in (sorted(set(compile_rule(r, k)[1])) or [""])]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(4)],
                                         ["rule", "kind", "action", "token"])


def _url_tokens(batches):
    """(url, token) rows; every url has the token '' too."""
    for batch in batches:
        rows = [(u, t) for u in batch.column("url").to_pylist() for t in ["", *tokens_of(u)]]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)],
                                         ["url", "token"])


@F.arrow_udf(T.BooleanType())
def _fit_pairs(url: pa.Array, rule: pa.Array, kind: pa.Array) -> pa.Array:
    known, out = {}, []
    for u, r, k in zip(url.to_pylist(), rule.to_pylist(), kind.to_pylist()):
        if (r, k) not in known:
            known[r, k] = re.compile(compile_rule(r, k)[0], re.DOTALL)
        out.append(fits(known[r, k], k, u, *split_url(u)))
    return pa.array(out, pa.bool_())


@F.arrow_udf(T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.StringType())]))
def _parts(url: pa.Array) -> pa.Array:
    parts = [split_url(u) for u in url.to_pylist()]
    return pa.StructArray.from_arrays([pa.array([p[i] for p in parts], pa.string()) for i in range(2)],
                                      ["host", "path"])


def _judge_joined(pages: DataFrame, rules: DataFrame, url: str) -> DataFrame:
    """The same for rule lists of any length: distinct urls and rules meet by
    token in a salted join, and the best fitting rules come back to the rows.
    ``n_run`` counts the candidates of a url, as in the broadcast form."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "url_filters")
    text = F.coalesce(F.col(url), F.lit("")).alias("url")
    counts = token_counts(pages.select(text), None)
    own = rules.mapInArrow(_compiled, "rule string, kind string, action string, token string")
    rarest = F.struct(F.coalesce("n", F.lit(0)), -F.length("token"), F.col("token"))
    index = (own.join(counts, "token", "left").groupBy("rule", "kind", "action").agg(F.min(rarest)["token"].alias("token"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))))
    salt = F.pmod(F.xxhash64("url"), F.lit(SALT)).cast("int").alias("salt")
    tokens = pages.select(text).distinct().mapInArrow(_url_tokens, "url string, token string").select("*", salt)
    hits = tokens.join(index, ["token", "salt"]).withColumn("fits", _fit_pairs("url", "rule", "kind"))

    def best(kind, *order):
        key = F.struct(*order, F.col("rule").alias("text"), F.col("action").alias("act"))
        return F.min(F.when(F.col("fits") & (F.col("kind") == kind), key))

    judged = (hits.groupBy("url").agg(
        F.count(F.lit(1)).cast("int").alias("n_run"),
        best("site", -F.length("rule"), -F.length(F.substring_index("rule", "/", 1))).alias("site"),
        best("pattern", F.col("action") != "allow", -F.length("rule")).alias("pat"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))))
    judged = scratch.save(judged.withColumnRenamed("url", "_url"), "judged")
    keep = without(pages, (*OUTPUT, "_url", "_salt", "_parts", "_row"))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row"), text.alias("_url"),
                        F.floor(F.rand(7) * SALT).cast("int").alias("_salt")).withColumn("_parts", _parts("_url"))
    return rows.join(judged, ["_url", "_salt"], "left").select(
        *[F.col(f"_row.`{c}`").alias(c) for c in keep], "_parts.host", "_parts.path", F.col("site.text").alias("rule"),
        F.col("pat.text").alias("pattern"), F.coalesce("n_run", F.lit(0)).alias("n_run"),
        F.coalesce("site.act", "pat.act", F.lit("allow")).alias("verdict"))


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(r, "site", a) for r, a in SITE_RULES] + [(r, "pattern", a) for r, a in PATTERN_RULES],
                                 RULES_SCHEMA)


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding site rule and verdict of every page's url."""
    return judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), default_rules(spark)).select(
        "page_id", "host", "path", "rule", "verdict")


_WORD = r"[a-z0-9\x{80}-\x{10FFFF}]"
_BLOCKED = "(?s)" + "|".join([
    r"(^|[^a-z0-9\x{80}-\x{10FFFF}])(casino|poker|betting|porn|xxx|viagra|pills|spam|warez|torrent)($|[^a-z0-9\x{80}-\x{10FFFF}])",
    r"^[^/?#]*?://([^/?#]*\.)?(ads|adserver)\.", "/popunder", r"/banners/.*\.gif$"])
_ALLOWED = "(?s)" + "|".join([
    r"(^|[^a-z0-9\x{80}-\x{10FFFF}])anti($|[^a-z0-9\x{80}-\x{10FFFF}])spam($|[^a-z0-9\x{80}-\x{10FFFF}])",
    r"^[^/?#]*?://([^/?#]*\.)?library\..*($|[^a-z0-9\x{80}-\x{10FFFF}])betting($|[^a-z0-9\x{80}-\x{10FFFF}])"])
OP12_SQL = f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url,
                  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw,
             translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM u),
p AS (SELECT *, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(rule, action) AS (VALUES {', '.join(f"('{r}', '{a}')" for r, a in SITE_RULES)}),
m AS (SELECT *, list_filter((SELECT list({{'rule': rule, 'action': action}} ORDER BY length(rule) DESC) FROM r),
             lambda x: ends_with('.' || host, '.' || split_part(x.rule, '/', 1))
               AND starts_with(path, substr(x.rule, strpos(x.rule, '/')))) AS best FROM p)
SELECT page_id, host, path, best[1].rule AS rule,
       CASE WHEN len(best) > 0 THEN best[1].action
            WHEN regexp_matches(low, '{_ALLOWED}') THEN 'allow'
            WHEN regexp_matches(low, '{_BLOCKED}') THEN 'block' ELSE 'allow' END AS verdict
FROM m
"""
