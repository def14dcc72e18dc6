"""Whitening, URL filters and the conversation trie: brute force and odd inputs."""

import collections
import hashlib
import itertools
import zlib

import numpy as np
import pytest

import __spark_entry__ as E
from logscan.llm import prefix_trie as trie
from logscan.llm import url_filters as urls
from logscan.llm import whitening as white

SF = "/root/testdata/sf0.001"


# -------------------------------------------------------------------- whitening
def integer_polynomial(m):
    """det(t - m) by the Faddeev-LeVerrier recursion over whole numbers."""
    d = len(m)
    c, k, one = [0] * d + [1], np.zeros((d, d), dtype=object), np.array(
        [[int(i == j) for j in range(d)] for i in range(d)], dtype=object)
    for i in range(1, d + 1):
        k = m @ k + c[d - i + 1] * one
        c[d - i] = -sum((m @ k)[j, j] for j in range(d)) // i
    return c


def random_scatter(d, n=40, seed=3, top=90):
    x = np.random.default_rng(seed).integers(-top, top, (n, d)).astype(object)
    return n * (x.T @ x) - np.outer(x.sum(axis=0), x.sum(axis=0))


def test_polynomial_modulo_and_joined(spark):
    for d in (1, 2, 3, 9):
        m = random_scatter(d)
        whole = integer_polynomial(m)
        for p in (101, 2_147_483_629):
            assert white.polynomial_modulo(np.array([[int(v) % p for v in r] for r in m]), p) == [v % p for v in whole]
        assert white.characteristic_polynomial(spark, m) == whole
    # zero pivots: a permutation-like matrix and a block of zeros
    m = np.array([[2, 0, 0, 1], [0, 0, 0, 0], [0, 0, 5, 0], [1, 0, 0, 2]], dtype=object)
    assert white.polynomial_modulo(m.astype(np.int64) % 10007, 10007) == [v % 10007 for v in integer_polynomial(m)]


def test_primes():
    some = white.primes_for(1 << 200)
    assert len(set(some)) == len(some) and np.prod([float(p) for p in some[:-1]]) > 2.0**200
    assert [n for n in range(60) if white.is_prime(n)] == [n for n in range(2, 60) if all(n % k for k in range(2, n))]


def test_roots_with_multiplicity_and_close_ones():
    def poly(roots):
        p = [1]
        for r in roots:
            p = [a - r * b for a, b in zip([0, *p], [*p, 0])]
        return p

    got = white.largest_roots(poly([7, 7, 5, 3, 0, 0]), 4, 25)
    assert [(round(r / 2**b, 60), m) for r, b, m in got] == [(7, 2), (5, 1), (3, 1)]
    close = [10**30 + 1, 10**30, 5]  # one part in 10^30 apart
    got = white.largest_roots(poly(close), 2, 3 * 10**30)
    assert [m for _, _, m in got] == [1, 1] and [-(-(r - 1) >> b) for r, b, _ in got] == close[:2]
    assert white.largest_roots(poly([0, 0]), 2, 1) == []


def test_eigenvectors_of_close_and_repeated_roots():
    m = random_scatter(12)
    poly = integer_polynomial(m)
    w, v = np.linalg.eigh(m.astype(float))
    for k, (r, b, many) in enumerate(white.largest_roots(poly, 4, int(np.trace(m)))):
        vector, = white.null_space(m, r, b, many)
        assert many == 1 and abs(r / 2**b / w[-1 - k] - 1) < 1e-13
        assert min(np.abs(vector - v[:, -1 - k]).max(), np.abs(vector + v[:, -1 - k]).max()) < 1e-10
    # eigenvalues 10^30 + 1 and 10^30: plain double precision cannot part them
    h = np.array([[2 * 10**30 + 1, 1], [1, 2 * 10**30 + 1]], dtype=object)
    (r1, b1, _), (r2, b2, _) = white.largest_roots(integer_polynomial(h), 2, 5 * 10**30)
    assert np.allclose(np.abs(white.null_space(h, r1, b1, 1)), 0.5**0.5) and np.allclose(
        white.null_space(h, r1, b1, 1) @ white.null_space(h, r2, b2, 1).T, 0)
    basis = white.null_space(np.diag([5, 5, 3]).astype(object), 5, 0, 2)
    assert np.allclose(basis @ basis.T, np.eye(2)) and np.allclose(basis[:, 2], 0)


def test_whole_vectors_and_exact_sums(spark):
    big = np.array([3e38, -3e38, 1e17, 2**54 + 0.0, -0.0, 0.1])
    x = white.quantized(big)
    assert x.tolist() == [white.LONG_MAX, white.LONG_MIN, 256 * 10**17 if 256 * 10**17 < 2**63 else white.LONG_MAX, 2**62, 0, 25]
    for v in (x, np.zeros(0, dtype=np.int64), np.array([127, -128]), np.array([200]), np.array([1 << 40])):
        assert white.unpacked(white.packed(v[None, :])).tolist() == [v.tolist()]
    rows = [[white.LONG_MAX, -5], [white.LONG_MIN, 7], [3, 4]]
    table = spark.createDataFrame([(2, v) for v in white.packed(np.array(rows))], "dim int, x binary").repartition(3)
    n, s, g = white.exact_sums(table)[2]
    o = np.array(rows, dtype=object)
    assert n == 3 and (s == o.sum(axis=0)).all() and (g == o.T @ o).all()


def check_whitening(rows, vectors):
    """Digest rows against numpy's eigendecomposition over the distinct vectors."""
    x = np.floor(256 * np.array([v for _, v in vectors], dtype=np.float64))
    u = np.unique(x, axis=0)
    n, d = u.shape
    w, axes = np.linalg.eigh(np.cov(u.T, bias=True).reshape(d, d))
    w, axes = w[::-1], axes[:, ::-1]
    deviation = np.square(n * x - u.sum(axis=0)).sum(axis=1)
    assert len(rows) == len(vectors) * min(4, d)
    for k in range(min(4, d)):
        own = [r for r in rows if r.component == k + 1]
        want = collections.Counter((i, int(e)) for (i, _), e in zip(vectors, deviation))
        assert collections.Counter((r.vec_id, r.deviation) for r in own) == want
        if w[k] < 1e-9:
            assert all(r.whitened is None and r.explained == 0 for r in own)
            continue
        z = (x - u.mean(axis=0)) @ axes[:, k] / np.sqrt(w[k])
        near = sorted((str(i), int(e), float(t)) for (i, _), e, t in zip(vectors, deviation, z))
        got = sorted((str(r.vec_id), r.deviation, r.whitened) for r in own)
        back = sorted((a, b, -t) for a, b, t in got)
        assert min(max(abs(p[2] - q[2]) for p, q in zip(near, side)) for side in (got, back)) < 1e-6
        assert all(r.n == n and r.identity_error < 1e-9 and abs(r.explained - w[k] / w.sum()) < 1e-9 for r in own)


def digest_rows(spark, vectors, kind="array<double>"):
    df = spark.createDataFrame(vectors, f"vec_id long, embedding {kind}, N int, Whitened string, extra string")
    out = white.whiten(df, white.fit_whitening(df))
    assert out.columns == ["vec_id", "embedding", "extra", *white.NEW]
    rows = []
    for r in out.collect():
        for k, w in enumerate(r.whitened):
            rows.append(collections.namedtuple("R", "vec_id component n deviation whitened explained identity_error")(
                r.vec_id, k + 1, r.n, r.deviation, w, r.explained[k], r.identity_error))
    return rows


def test_whitening_against_numpy(spark):
    emb = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(E.queries()["op11_whitening"](spark, SF).collect(), emb)
    rng = np.random.default_rng(5)
    few = [(i, rng.normal(size=6).tolist()) for i in range(30)]
    few += [(3, few[3][1]), (None, few[4][1]), *[(100 + i, few[0][1]) for i in range(40)]]  # repeats and a null id
    odd = [(200, None), (201, [1.0, None] + [0.0] * 4), (202, [float("nan")] + [0.0] * 5), (203, [float("inf")] * 6)]
    check_whitening(digest_rows(spark, [(i, v, 1, "x", "y") for i, v in few + odd]), few)


def test_whitening_of_flat_and_empty_tables(spark):
    flat = [(i, [1.0, float(i % 2), 2.0, 3.0, 4.0]) for i in range(6)]
    check_whitening(digest_rows(spark, [(i, v, 1, None, None) for i, v in flat]), flat)
    same = digest_rows(spark, [(i, [0.5, 0.25], 1, None, None) for i in range(3)])
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(1, 0, None, None, None)] * 6
    mixed = digest_rows(spark, [(1, [], 1, None, None), (2, [1.0], 1, None, None), (3, [2.0], 1, None, None)])
    assert [(r.vec_id, r.component, abs(r.whitened)) for r in sorted(mixed)] == [(2, 1, 1.0), (3, 1, 1.0)]
    assert digest_rows(spark, []) == [] and digest_rows(spark, [(1, None, 1, None, None)]) == []


# ------------------------------------------------------------------ URL filters
ODD_URLS = [None, "", "example.com/en/", "http://", "http://com", "HTTP://WWW.Example.COM/en/x", "http://www.example.com/EN/",
            "http://a.example.com/en/1?u=http://b.net/es/", "x://net/es/", "http://my-example.com/en/", "http://user@x.net/fr/",
            "http://x.net:80/fr/", "http://x.net/fr", "http://.net/fr/", "a b://\nx.net/fr/\n?q", "://example.com/en/",
            "http://best.casino/", "http://bestcasino.org/", "http://ads.x.org/", "http://loads.x.org/", "ftp://x.org/a/popunder9",
            "http://anti-spam.org/", "http://x.org/banners/a.GIF", "http://x.org/banners/a.gif?", "casino",
            "http://library.x.org/betting", "http://x.org/" + "spam/" * 20_000, "http://été.org/ÉTÉ#com/"]


def plain_judge(url, rules):
    """All rules against the url, without tokens or expressions for sites."""
    import re
    text = url or ""
    m = re.search(r"://([^/?#]*)([^?#]*)", text)
    low = re.sub("[A-Z]", lambda c: c[0].lower(), text)
    host = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]) if m else ""
    path, best = m[2] if m else "", []
    for r, k, a in rules:
        h, slash, p = r.partition("/")
        if k == "site" and m and ("." + host).endswith("." + h) and path.startswith(slash + p):
            best.append((-len(r), -len(h), r, a))
    if best:
        return host, path, min(best)[2], min(best)[3]
    found = {a for r, k, a in rules if k == "pattern" and re.search(urls.compile_pattern(r)[0], low, re.S)}
    return host, path, None, "block" if found == {"block"} else "allow"


RULES = [(r, "site", a) for r, a in urls.SITE_RULES] + [(r, "pattern", a) for r, a in urls.PATTERN_RULES]


@pytest.mark.parametrize("bound", [urls.BROADCAST_RULES, 0])
def test_urls_against_all_rules(spark, bound):
    rows = [(i, u, "h", 1, 2.0) for i, u in enumerate(ODD_URLS)] + [(None, ODD_URLS[5], None, None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, Host string, n_run int, _salt double")
    rules = spark.createDataFrame(RULES + [(None, "site", "block"), ("", "pattern", "block"), ("com/", "site", "block")],
                                  urls.RULES_SCHEMA)
    out = urls.judge_urls(pages, rules, broadcast_rules=bound)
    assert sorted(out.columns) == sorted(["page_id", "url", *(["_salt"] if bound else []), *urls.OUTPUT])
    got = [(r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in out.collect()]
    want = [(i, u, *plain_judge(u, RULES)) for i, u, *_ in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert urls.judge_urls(pages.limit(0), rules, broadcast_rules=bound).count() == 0
    none = urls.judge_urls(pages, rules.limit(0), broadcast_rules=bound).collect()
    assert len(none) == len(rows) and {(r.rule, r.verdict, r.n_run) for r in none} == {(None, "allow", 0)}


def test_rule_tokens_stand_whole_in_fitting_urls():
    assert urls.compile_site("example.com/en/x")[1] == ["example", "com", "en"]
    assert urls.compile_site("a.b")[1] == ["a", "b"]
    assert urls.compile_pattern("ads^banner*top^end|")[1] == ["end"]
    assert urls.compile_pattern("||ads.x")[1] == ["ads"] and urls.compile_pattern("*a*")[1] == []
    index = urls.RuleIndex([("a.b.c/", "site", "block"), ("zz", "pattern", "block")], {"a": 9, "b": 1, "c": 5})
    assert list(index.by_token) == ["b"] and [e[1] for e in index.always] == ["zz"]
    assert index.judge("http://q.c/")[-1] == 1 and index.judge("http://a.b.c/")[-1] == 2  # rules run, of two


# --------------------------------------------------------------------- the trie
def brute_trie(paths):
    """Nodes of {conv_id: [(role, text), ...]} by plain dictionaries."""
    members = collections.defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    out = []
    for p, own in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in own if len(paths[c]) == len(p)))
        out.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), kids[p],
                    sum(not kids[q] for q in below),
                    sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def plain_paths(rows):
    out = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            out[c].append((t is not None, t or 0, (role or "", text or "")))
    return {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in out.items()}


TURNS = "conv_id long, turn long, role string, text string, Depth int, path string, Digest string"


def turn_table(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", None) for r in rows], TURNS)


@pytest.mark.parametrize("shard", [1, 3, 17, trie.SHARD_TURNS])
def test_trie_against_brute_force(spark, shard):
    rng = np.random.default_rng(shard)
    rows = []
    for c in range(70):
        for t in range(int(rng.integers(0, 6))):
            rows.append((c, t, "u" if t % 2 else None, [None, "", "a", "bé"][int(rng.integers(0, 4))]))
    rows += [(1000 + c, t, "user", f"copied {t}") for c in range(60) for t in range(4)]  # one hot conversation
    rows += [(2000, t, "x", "long " * 2000) for t in range(300)] + [(2001, t, "x", "long " * 2000) for t in range(290)]
    rows += [(None, 1, "u", "t"), (3000, None, None, None), (-7, 5, "u", "a")]
    df = turn_table(spark, rows)
    got = sorted((tuple(r) for r in trie.conversation_trie(df, shard).select(*trie.NODE).collect()), key=str)
    assert got == brute_trie(plain_paths(rows))


def test_trie_of_odd_tables(spark):
    assert trie.conversation_trie(turn_table(spark, [])).count() == 0
    assert trie.conversation_trie(turn_table(spark, [(None, 1, "a", "b")])).count() == 0
    twice = [(1, 0, "u", "a"), (1, 0, "u", "a"), (1, 0, "u", "a")]  # repeated rows are turns of their own
    nodes = trie.conversation_trie(turn_table(spark, twice))
    assert sorted(r.depth for r in nodes.collect()) == [0, 1, 2, 3]
    texts = trie.node_turns(nodes, turn_table(spark, twice)).collect()
    assert sorted((r.depth, r.role, r.text) for r in texts if r.depth) == [(d, "u", "a") for d in (1, 2, 3)]
    # role and text are parted: "a" + "bc" is not "ab" + "c"
    two = trie.conversation_trie(turn_table(spark, [(1, 0, "a", "bc"), (2, 0, "ab", "c")]))
    assert two.count() == 3


def test_trie_query_rebuilds(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    own = plain_paths(rows)
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    got = sorted((tuple(r) for r in E.queries()["op13_prefix_trie"](spark, SF).select(*trie.NODE).collect()), key=str)
    assert got == brute_trie(built)


def test_find_close_against_a_stack():
    rng = np.random.default_rng(2)
    for n in (1, 2, 31, 32, 33, 64, 500, 5000):
        seq, depth = [], 0
        for left in range(2 * n, 0, -1):
            go = depth == 0 or (depth < left and rng.random() < 0.5)
            seq.append(go)
            depth += 1 if go else -1
        for bits in (np.array(seq), np.array([True] * n + [False] * n), np.array([True, False] * n)):
            stack, want = [], {}
            for i, b in enumerate(bits.tolist()):
                if b:
                    stack.append(i)
                else:
                    want[stack.pop()] = i
            opens = np.flatnonzero(bits)
            assert trie.Parentheses(bits).find_close(opens).tolist() == [want[i] for i in opens.tolist()]


def test_range_minima():
    v = np.array([5, 3, 8, 1, 9, 2])
    spans = [(a, b) for a, b in itertools.combinations(range(7), 2)]
    got = trie._range_minima(v, np.array([a for a, _ in spans]), np.array([b for _, b in spans]))
    assert got.tolist() == [min(v[a:b]) for a, b in spans]
