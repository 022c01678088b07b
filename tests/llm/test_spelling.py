"""Spelling variants against brute force, with many shards and slices, and edge rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n bigint, id string, form string, root string, length int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, "x", "f", "r", 3) for i, t in rows], SCHEMA)


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _brute(rows, least_length=6, least_count=5):
    c = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-z\u00C0-\u00FF]+", t or ""):
            w = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= least_length:
                c[w] += 1
    c = {w: n for w, n in c.items() if n >= least_count}
    near = {w: [v for v in c if v != w and _near(w, v)] for w in c}
    form = {}
    for w, vs in near.items():
        if vs:
            best = min(vs, key=lambda v: (-c[v], v))
            if c[best] >= 5 * c[w]:
                form[w] = best
    out = {}
    for w in c:
        root = w
        while root in form:
            root = form[root]
        out[w] = (c[w], form.get(w), c[form[w]] if w in form else None, root, len(near[w]))
    return out


def _got(df):
    rows = df.collect()
    got = {r.word: (r.n, r.form, r.form_n, r.root, r.n_near) for r in rows}
    assert len(got) == len(rows)
    return got


def _corpus(seed, words, docs):
    r = random.Random(seed)
    letters = "abcde\u00e9\u00c9\u00ffz"
    base = ["".join(r.choice(letters) for _ in range(r.randrange(5, 9))) for _ in range(words)]
    pool = []
    for w in base:
        pool += [w] * r.choice([1, 2, 8, 60])
        for _ in range(r.randrange(4)):
            i, x = r.randrange(len(w)), r.choice(letters)
            pool += [r.choice([w[:i] + w[i + 1:], w[:i] + x + w[i:], w[:i] + x + w[i + 1:]])] * r.choice([1, 3, 12])
    return [(i, " ".join(r.choice([x, x.upper() if r.random() < .1 else x]) + r.choice(["", ".", "1", "\u00d7", "\u4e00", "\n"])
                         for x in r.choices(pool, k=120))) for i in range(docs)]


@pytest.mark.parametrize("kw", [{}, {"shard_words": 7, "slice_bytes": 64, "flush": 50}])
def test_equal_to_brute_force(spark, kw):
    rows = _corpus(5, 40, 60)
    want = _brute(rows)
    assert any(v[1] for v in want.values()) and any(v[4] > 2 for v in want.values())
    assert any(v[3] != v[1] for v in want.values() if v[1])  # a chain of two forms
    assert _got(spelling.variants(_docs(spark, rows).repartition(5), **kw)) == want


def test_edits_are_each_neighbour_once():
    words = [b"aabbca", b"aaaaaa", b"abcabc"]
    alphabet = np.frombuffer(b"abc", np.uint8)
    chars = spelling.letters(words, 6)
    for deletions in (True, False):
        made = []
        for h, rows, i, put in spelling.edits(chars, alphabet, deletions):
            for j, k in enumerate(rows):
                w = words[k][:i] + (b"" if put is None else bytes([put[j]])) + words[k][i + 1:]
                assert spelling.hashes(spelling.letters([w], len(w)))[0] == h[j]
                made.append((k, w))
        assert len(made) == len(set(made))
        want = ({(k, w[:i] + w[i + 1:]) for k, w in enumerate(words) for i in range(6)} if deletions else
                {(k, w[:i] + bytes([c]) + w[i + 1:]) for k, w in enumerate(words) for i in range(6) for c in b"abc" if c > w[i]})
        assert set(made) == want


def test_edge_rows(spark):
    long = "abcdefgh " * 50_000
    rows = [(1, None), (2, ""), (3, "123 \u4e00 \U0001F600"), (None, "orange " * 9), (4, long), (4, long), (5, "oranges " * 50), (6, "x" * 100_000 + " " + "y" * 100_000),
            (7, "Orange ORANGE orange")]
    assert _got(spelling.variants(_docs(spark, rows))) == _brute(rows)
    assert spelling.variants(_docs(spark, [])).count() == 0
    assert spelling.variants(_docs(spark, [(1, None), (2, "short words only")])).count() == 0


def test_ties_go_to_the_smaller_word(spark):
    rows = [(1000 + i, " ".join(["planet"] * 5 + ["planes"] * 30 + ["plane\u00e9"] * 30 + ["planec"] * 30)) for i in range(3)]
    got = _got(spelling.variants(_docs(spark, rows)))
    assert got == _brute(rows) and got["planet"][1] == "planec"
