"""Vector codes, whitening and URL filters against plain versions, and their defined cases."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantspark.llm import codes, polynomials, urls, vectors, whitening

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, label int, v string, codes string, id string"


@pytest.fixture(scope="module")
def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25, 0.0, 0.125], 1), (2, None, 1), (3, [0.5, None, 0.0, 0.0], 1), (4, [nan, 0.0, 0.0, 0.0], 2), (5, [inf, 0.0, 0.0, 0.0], 2),
            (6, [0.1, 0.2], None), (6, [0.1, 0.2], None), (None, [0.1, 0.2, 0.3, 0.4], 2), (7, [], 2), (8, [-0.001, -0.5, 0.3, 0.9], None)]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], VECTORS)


# 11 vector codes

def _lloyd(x, ids, parts, entries, rounds):
    """Full scans: (codes, errors, codebooks)."""
    n, width = x.shape
    x = np.pad(x, ((0, 0), (0, -width % parts))).reshape(n, parts, -1)
    order = sorted(range(n), key=lambda i: (ids[i] is None, ids[i] or 0, x[i].ravel().tolist()))
    first = [i for k, i in enumerate(order) if k == 0 or ids[order[k - 1]] != ids[i]][:entries]
    books = [[x[i, s].tolist() for i in first] for s in range(parts)]

    def assign():
        out = []
        for i in range(n):
            out.append([min((sum((a - b) ** 2 for a, b in zip(x[i, s].tolist(), e)), k) for k, e in enumerate(books[s])) for s in range(parts)])
        return out

    for _ in range(rounds):
        got = assign()
        for s in range(parts):
            for k in range(len(first)):
                mine = [x[i, s] for i in range(n) if got[i][s][1] == k]
                if mine:
                    books[s][k] = [sum(int(m[c]) for m in mine) // len(mine) for c in range(x.shape[2])]
    got = assign()
    return [[k for _, k in row] for row in got], [[d for d, _ in row] for row in got], books


def test_reassign_equals_full_scans():
    rng = np.random.default_rng(3)
    for trial in range(200):
        p, e = rng.integers(-3, 4, (60, 2)), rng.integers(-3, 4, (9, 2))  # many ties
        code, dist = codes.nearest(p, e)
        moved = rng.random(9) < rng.choice([0, 0.2, 0.6, 1])
        new = np.where(moved[:, None], rng.integers(-3, 4, (9, 2)), e)
        got = codes.reassign(p, new, (new != e).any(axis=1), code, dist)
        want = codes.nearest(p, new)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


@pytest.mark.parametrize("rounds", [0, 1, 5])
def test_codes_equal_plain_lloyd(spark, rounds):
    rng = np.random.default_rng(rounds)
    ids = [*rng.permutation(150).tolist(), 3, 3, None]
    x = rng.integers(-20, 20, (len(ids), 10))
    rows = spark.createDataFrame([(i, (v / 256).tolist(), 0) for i, v in zip(ids, x)], "vec_id long, embedding array<double>, label int").repartition(5)
    coded, books = codes.compress(rows, parts=4, entries=12, rounds=rounds)
    want_codes, want_errors, want_books = _lloyd(x, ids, 4, 12, rounds)
    assert books.tolist() == want_books
    got = sorted((r.id is None, r.id or 0, np.frombuffer(r.codes, np.uint16).tolist(), np.frombuffer(r.dists, np.int64).tolist()) for r in coded.collect())
    assert got == sorted((i is None, i or 0, c, d) for i, c, d in zip(ids, want_codes, want_errors))


def test_code_cases(spark, odd_vectors):
    coded, books = codes.compress(odd_vectors)
    rows = coded.collect()
    assert sorted(str(r.id) for r in rows) == sorted(map(str, [1, 6, 6, None, 7, 8]))
    assert books.shape == (16, 5, 1)
    assert all(sum(np.frombuffer(r.dists, np.int64)) == 0 for r in rows)  # as many entries as vectors
    none, no_books = codes.compress(odd_vectors.filter(F.lit(False)))
    assert none.count() == 0 and codes.books_digest(no_books) == hashlib.sha256(b"").hexdigest()
    assert codes.compress(odd_vectors.filter("vec_id = 7"))[0].count() == 1
    with pytest.raises(Exception, match="is 16777216 or more"):
        vectors.integer_vectors(spark.createDataFrame([(1, [1e9])], "i long, e array<double>"), "e", {"i": "i"}).collect()


def test_label_totals(spark):
    rng = random.Random(1)
    rows = [(i, None if i % 9 == 0 else 1 if i % 3 else 1000 + i, rng.randrange(100)) for i in range(900)]
    got = codes.with_label_totals(spark.createDataFrame(rows, "i long, l long, e long"), "l", "e", "t").collect()
    totals = {}
    for _, l, e in rows:
        totals[l] = totals.get(l, 0) + e
    assert len(got) == len(rows) and all(r.t == totals[r.l] for r in got)


# 12 URL filters

def _plain_judge(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for r in rules:
        if r.by_host:
            h, p = r.text.split("/", 1)
            if (lower == h or lower.endswith("." + h)) and path.startswith("/" + p):
                fits.append((-len(r.text), -len(h), r.text, r.action))
    if fits:
        return lower, path, min(fits)[2], min(fits)[3], None
    target = lower + rest[len(host):]
    general = [(r.action != "allow", r.text, r.action) for r in rules if not r.by_host and re.match(r.regex.replace(r"\z", r"\Z"), target)]
    return lower, path, None, min(general)[2] if general else "allow", min(general)[1] if general else None


URLS = [None, "", "no scheme", "http://", "https://NET/", "http://a.net", "http://a.NET/x", "http://x.example.net/en/1?a=b", "http://example.net/en",
        "http://example.net/EN/1", "http://notexample.net/en/1", "http://www.example.com/de/", "http://b.org/fr/9#top", "http://net:80/", "a://b://c.net/",
        "http://a.com/login?next=http://x.net/en/", "http://ads.b.com/", "http://b.com/ads/1", "http://b.com/about/ads/policy", "http://b.com/x?sessionid=3",
        "http://B.com/wp-login.php", "http://b.com/wp-login.phpx", "http://b.com/banner/1/2.gif", "http://b.com/calendar/\n/day/3", "http://ünet/", "http://b.com/%20ads/",
        "http://" + "a." * 20_000 + "net/" + "x" * 50_000, "http://b.net/\n", "http://b.com/robots.txt", "://net/"]


def test_url_cases(spark):
    rows = spark.createDataFrame([(i if i % 7 else None, u, "x", "y", "z") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, target string, id string")
    got = urls.judge(rows)
    by_text = sorted(zip([u for u in URLS * 2], [(r.host, r.path, r.rule, r.verdict, r.pattern) for r in got.collect()]), key=str)
    assert len(by_text) == 2 * len(URLS)
    for u, row in by_text:
        assert row == _plain_judge(u, urls.RULES), u
    assert urls.judge(rows.filter(F.lit(False))).count() == 0


def test_index_fetches_all_that_fit():
    rng = random.Random(5)
    words = ["ads", "net", "en", "a", "b1", "x-y", "Q", "é"]
    rules = []
    for _ in range(400):
        text = "".join(rng.choice(["/", "*", "^", ".", "?", *words]) for _ in range(rng.randrange(1, 7)))
        if rng.random() < 0.5:
            rules.append(urls.Rule(rng.choice(["", "||"]) + text, rng.choice(["block", "allow"])))
        else:
            rules.append(urls.Rule(rng.choice(words).lower() + "/" + text.replace("*", ""), "block", True))
    counts = {t: rng.randrange(100) for r in rules for t in r.tokens}
    filed, bare = urls.index(rules, counts)
    assert sorted([*bare, *(i for at in filed.values() for i in at)]) == list(range(len(rules)))
    hits = 0
    for _ in range(1500):
        host = ".".join(rng.choice(words).lower() for _ in range(rng.randrange(1, 4)))
        target = host + "".join(rng.choice(["/", ".", "?", "-", *words]) for _ in range(rng.randrange(0, 8)))
        tokens = set(re.findall(urls.TOKEN, target.translate(str.maketrans("Q", "q"))))
        fetched = {i for t in tokens for i in filed.get(t, ())} | set(bare)
        for i, r in enumerate(rules):
            if re.match(r.regex.replace(r"\z", r"\Z"), target):
                hits += 1
                assert i in fetched, (r, target)
    assert hits > 500


def test_rules_are_filed_under_their_rarest_token(spark):
    rules = [urls.Rule("common.example/rare/", "block", True), urls.Rule("*", "block")]
    pages = spark.createDataFrame([(i, f"http://common.example/{'rare' if i == 0 else 'x'}/") for i in range(50)], "page_id long, url string")
    targets = pages.select(urls.parts_of("url")[2].alias("target"))
    counts = urls.token_counts(targets, rules)
    assert counts == {"common": 50, "example": 50, "rare": 1} and urls.index(rules, counts) == ({"rare": [0]}, [1])
    got = {r.id: r for r in urls.judge(pages, rules).collect()}
    assert got[0].tried == 1 and got[0].rule == "common.example/rare/" and got[1].pattern == "*"


# 13 whitening

def test_polynomial_by_remainders(spark):
    rng = np.random.default_rng(2)
    for d in (1, 2, 3, 7):
        x = rng.integers(-40, 40, (d + 2, d))
        m = [[int(v) for v in row] for row in x.T @ x]
        got = polynomials.characteristic_polynomial(spark, m)
        for at in (-3, 0, 2, 5):  # equal to the determinant of at - m at more points than matter
            a = [[(at if i == j else 0) - m[i][j] for j in range(d)] for i in range(d)]
            assert sum(c * at**k for k, c in enumerate(got)) == _determinant(a)
        assert got[-1] == 1 and got[d - 1] == -sum(m[i][i] for i in range(d))


def _determinant(a):
    if not a:
        return 1
    return sum((-1) ** c * a[0][c] * _determinant([row[:c] + row[c + 1:] for row in a[1:]]) for c in range(len(a)) if a[0][c])


def test_roots_with_multiplicity():
    poly = [1]
    for root in (0, 3, 3, 7, 1000):
        poly = [(poly[k - 1] if k else 0) - root * (poly[k] if k < len(poly) else 0) for k in range(len(poly) + 1)]
    assert [polynomials.roots_above(poly, a, 1) for a in (-1, 0, 5, 6, 7, 14, 2000)] == [5, 4, 4, 2, 2, 1, 0]
    one = 1 << polynomials.ROOT_BITS
    assert polynomials.largest_roots(poly, 5, 1013) == [1000 * one, 7 * one, 3 * one, 3 * one, 0]
    two = polynomials.largest_roots([2, -4, 1], 2, 4)  # 2 + sqrt 2 and 2 - sqrt 2
    assert abs(two[0] - (2 * one + math.isqrt(2 * one * one))) <= 1 and abs(two[1] - (2 * one - math.isqrt(2 * one * one))) <= 1


def _rows(spark, x, ids=None):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in zip(ids or range(len(x)), x)], "vec_id long, embedding array<double>").repartition(4)


def test_whitening_equals_dense_eigenvectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = df.unionByName(df.limit(40))  # repeats don't enter the fit
    got = whitening.whiten(rows).toPandas()
    e = df.toPandas()
    x = np.floor(256 * np.stack(e.embedding).astype(float)).astype(np.int64)
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    val, vec = np.linalg.eigh(np.cov(u.T, bias=True))
    dev = dict(zip(e.vec_id, ((n * x - s) ** 2).sum(axis=1).tolist()))
    assert len(got) == 4 * (len(e) + 40) and (got.n == n).all() and got.identity_error.max() < 1e-9
    assert all(int(a) == dev[i] for i, a in zip(got.id, got.deviation))
    for k in range(4):
        mine = got[got.component == k + 1].drop_duplicates("id").set_index("id").loc[e.vec_id]
        want = (x - s / n) @ vec[:, -1 - k] / np.sqrt(val[-1 - k])
        sign = np.sign(want @ mine.whitened)
        assert np.abs(want * sign - mine.whitened).max() < 1e-9 and abs(mine.explained.iloc[0] / (val[-1 - k] / val.sum()) - 1) < 1e-12


def test_whitening_of_repeated_and_zero_eigenvalues(spark):
    # the corners of a cross-polytope have one eigenvalue, repeated
    x = [[s * (i == j) / 2 for j in range(5)] for i in range(5) for s in (1, -1)]
    got = whitening.whiten(_rows(spark, x)).toPandas()
    assert got.identity_error.iloc[0] < 1e-12 and np.allclose(got.explained, 0.2)
    y = got.pivot(index="id", columns="component", values="whitened").to_numpy()
    assert np.abs(y.T @ y / len(x) - np.eye(4)).max() < 1e-12
    # three points span two dimensions
    flat = whitening.whiten(_rows(spark, [[0.0, 0, 0, 0, 0], [1.0, 0, 0, 0, 0], [0.0, 1, 1, 0, 0]])).toPandas()
    assert flat[flat.component <= 2].whitened.notna().all() and flat[flat.component > 2].whitened.isna().all()
    assert flat.identity_error.iloc[0] < 1e-12 and (flat[flat.component > 2].explained == 0).all()
    # near ties: two variances that differ in the last place
    rng = np.random.default_rng(0)
    wide = rng.integers(-200, 200, (300, 12)) / 256
    near = whitening.whiten(_rows(spark, wide.tolist())).toPandas()
    assert near.identity_error.iloc[0] < 1e-12


def test_whitening_cases(spark, odd_vectors):
    got = whitening.whiten(odd_vectors).collect()
    assert len(got) == 4 * 6 and {r.n for r in got} == {5}
    assert whitening.whiten(odd_vectors.filter(F.lit(False))).count() == 0
    one = whitening.whiten(_rows(spark, [[0.5, 0.25]] * 3)).collect()
    assert len(one) == 6 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 and r.n == 1 for r in one)
    single = whitening.whiten(_rows(spark, [[0.5], [0.25], [-3.0]], [1, 1, 2])).collect()
    assert [r.component for r in single] == [1, 1, 1] and single[0].explained == 1.0
    assert {r.deviation for r in single} == {int((3 * v - (128 + 64 - 768)) ** 2) for v in (128, 64, -768)}


def test_wide_offsets_stay_exact():
    w = whitening.Whitening.__new__(whitening.Whitening)
    w.n, w.s = 1 << 50, [5, -7]
    off = w.offsets(np.array([[1 << 20, -3]]))
    assert [int(d) for d in w.squares(off)] == [((1 << 70) - 5) ** 2 + (-3 * (1 << 50) + 7) ** 2]
    w.n = 1 << 30
    off = w.offsets(np.array([[1 << 20, -3]]))
    assert off.dtype == np.int64 and [int(d) for d in w.squares(off)] == [((1 << 50) - 5) ** 2 + (-3 * (1 << 30) + 7) ** 2]
