"""URL filter: rules, features, trees and edge rows."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import urls

SCHEMA = "page_id bigint, url string, host string, rule string, margin string, fold int, f0 int, verdict string"


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, "h", "r", "m", 1, 2, "v") for i, u in rows], SCHEMA)


def test_rules_by_hand(spark):
    given = {
        "http://a.com/x": ("a.com", "/x", "com/", "allow"),
        "HTTP://A.Example.COM/en/1": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "http://www.example.com/en/1?x#y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://x.www.example.com/en/": ("x.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"),
        "http://a.net/ES/1": ("a.net", "/ES/1", None, None),
        "http://net/fr/": ("net", "/fr/", "net/fr/", "block"),
        "http://a.com": ("a.com", "", None, None),
        "http://a.com?q=/": ("a.com", "", None, None),
        "http://com./x": ("com.", "/x", None, None),
        "a.com/x": ("", "", None, None),
        "x://y://a.com/": ("y:", "//a.com/", None, None),
        "http://\u00c4.COM/": ("\u00c4.com", "/", "com/", "allow"),
        "http:///en/": ("", "/en/", None, None),
    }
    rows = {r.page_id: r for r in urls.judge(_pages(spark, enumerate(given)), trees=1).collect()}
    for i, (u, want) in enumerate(given.items()):
        r = rows[i]
        assert (r.host, r.path, r.rule) == want[:3], u
        assert r.verdict == want[3] if want[3] else r.verdict in ("allow", "block")


def test_equal_rules_are_ordered():
    rules = [("a.b", "/c/", "allow"), ("a.b", "/c/", "block"), ("b", "/c/d/", "allow"), ("b", "/", "block")]
    assert urls.ranked(rules) == [rules[1], rules[0], rules[2], rules[3]]


def test_features_by_hand(spark):
    given = ["http://a.b.com/x/y//z.html?p=1&&q=2#f", "", "12345678", "http://h/" + "ab" * 500]
    rows = spark.createDataFrame([(u,) for u in given], "url string").select("url", F.array(*urls.lexical(F.col("url"))).alias("f")).collect()
    for r in rows:
        n = len(r.url)
        bits = -sum(c / n * math.log2(c / n) for c in Counter(r.url).values()) if n else 0.0
        digits = sum(c.isdigit() for c in r.url) * 1000 // max(n, 1)
        assert r.f[0] == min(31, n // 4) and r.f[2] == min(31, digits // 32)
        assert r.f[3] == min(31, math.floor(bits * 100 + 0.5) // 16)
    assert [rows[0].f[i] for i in (1, 4, 5)] == [3, 2, 3] and rows[1].f == [0] * 6


def _brute(rows, trees, depth, rate):
    """Boosting in plain Python, one row at a time."""
    m = [0] * len(rows)
    for _ in range(trees):
        p = [1 / (1 + math.exp(-x / urls.UNIT)) for x in m]
        g = [n * math.floor(q * urls.UNIT + 0.5) - y * urls.UNIT for (_, n, y), q in zip(rows, p)]
        h = [n * math.floor(q * (1 - q) * urls.UNIT + 0.5) for (_, n, _), q in zip(rows, p)]
        node = [1] * len(rows)
        for _ in range(depth):
            for at in set(node):
                own = [i for i in range(len(rows)) if node[i] == at]
                best, cut = 0.0, urls.NO_SPLIT
                for f in range(9):
                    for b in sorted({rows[i][0][f] for i in own}):
                        left = [i for i in own if rows[i][0][f] <= b]
                        gl, hl = float(sum(g[i] for i in left)), float(sum(h[i] for i in left))
                        gr, hr = sum(g[i] for i in own) - gl, sum(h[i] for i in own) - hl
                        if min(hl, hr) >= urls.LEAST:
                            gain = (gl * gl / (hl + urls.LAMBDA) + gr * gr / (hr + urls.LAMBDA)
                                    - (gl + gr) * (gl + gr) / (hl + hr + urls.LAMBDA))
                            if gain > best:
                                best, cut = gain, (f, b)
                for i in own:
                    node[i] = 2 * at + (rows[i][0][cut[0]] > cut[1])
        for at in set(node):
            own = [i for i in range(len(rows)) if node[i] == at]
            v = math.floor(-float(sum(g[i] for i in own)) * rate * urls.UNIT / (float(sum(h[i] for i in own)) + urls.LAMBDA) + 0.5)
            for i in own:
                m[i] += v
    return m


def test_trees_equal_brute_force(spark):
    import random
    r = random.Random(7)
    rows = []
    for _ in range(80):
        x = [r.randrange(0, 12) for _ in range(9)]
        n = r.randrange(1, 9)
        rows.append((x, n, min(n, r.randrange(0, n + 1) if x[2] > 6 else int(x[4] > 8) * n)))
    df = spark.createDataFrame([(*x, n, y) for x, n, y in rows], ", ".join(f"f{i} int" for i in range(9)) + ", n bigint, blocked bigint").repartition(4)
    trees = urls.fit(df, trees=3)
    got = {tuple(x[:9]): x.m for x in df.select(*[f"f{i}" for i in range(9)], urls.margin_of(trees).alias("m")).collect()}
    assert [got[tuple(x)] for x, _, _ in rows] == _brute(rows, 3, urls.DEPTH, urls.RATE)


def test_accuracy_on_urls_held_out(spark):
    """Labels that follow lexical features are learned; a fifth of the urls is held out."""
    import random
    r = random.Random(3)
    rows = []
    for i in range(1500):
        bad = r.random() < 0.4
        host = f"{'www.' if r.random() < .5 else ''}site{r.randrange(40)}.{r.choice(['org', 'io'])}"
        path = "/" + "/".join(f"{r.randrange(10 ** 7)}" if bad else r.choice(["news", "about", "blog", "team"]) for _ in range(r.randrange(1, 4)))
        rows.append((i, f"http://{host}{path}" + ("?a=1&b=2&c=3" if bad and r.random() < .7 else ""), int(bad)))
    df = spark.createDataFrame(rows, "page_id bigint, url string, blocked int")
    out = urls.judge(df, rules=[], labelled=df.where("page_id % 5 <> 0").select("url", "blocked"), trees=6)
    held = out.where("page_id % 5 = 0").join(df, "page_id")
    assert held.where((F.col("verdict") == "block") == (F.col("blocked") == 1)).count() >= 0.95 * held.count()


def test_edge_rows(spark):
    rows = [(1, None), (None, "http://a.com/x"), (2, ""), (3, "http://a.net/es/" + "x" * 300_000), (4, "http://a.com/x"), (4, "http://a.com/x"),
            (5, "http://" + "".join(chr(0x4e00 + i) for i in range(3000)))]
    got = sorted(((r.page_id, r.host[:6], r.rule, r.verdict) for r in urls.judge(_pages(spark, rows), trees=1).collect()), key=str)
    assert len(got) == len(rows)
    assert [g for g in got if g[0] == 4] == [(4, "a.com", "com/", "allow")] * 2
    assert [g for g in got if g[0] == 3] == [(3, "a.net", "net/es/", "block")]
    assert urls.judge(_pages(spark, []), trees=1).count() == 0
    nothing = urls.judge(_pages(spark, [(1, "http://a.org/"), (2, None)])).collect()  # no labelled urls
    assert all(r.verdict == "allow" and r.margin == 0 for r in nothing)


@pytest.mark.parametrize("train_rows", [20, 10 ** 6])
def test_the_sample_bounds_training_only(spark, train_rows):
    rows = [(i, f"http://s{i % 7}.net/{'es' if i % 2 else 'de'}/{i}") for i in range(200)]
    out = urls.judge(_pages(spark, rows), train_rows=train_rows, trees=1).collect()
    assert len(out) == 200 and all(r.verdict == "block" for r in out if "/es/" in r.path)
