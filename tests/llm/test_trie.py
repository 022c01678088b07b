"""Conversation trie against brute force: shared prefixes, long conversations, many equal
ones, and edge rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd

from ledgerlake.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, depth int, owner string, n bigint, part int"


def _table(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "o", 2, 3) for r in rows], SCHEMA)


def _brute(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[c].append(((t is not None, t or 0), sha, role, text))
    for v in turns.values():
        v.sort()
    seq = {}
    for c, own in turns.items():
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 9
        seq[c] = [x[2:] for x in turns.get(base, [])[:h] + own[h:]]
    members = defaultdict(list)
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    below = {}
    for k in sorted(members, key=len, reverse=True):
        saved = (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
        below[k] = (sum(below[x][0] for x in kids[k]) or 1, saved + sum(below[x][1] for x in kids[k]))
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), len(kids[k]), *below[k],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seq[c]) == len(k)).encode()).hexdigest())
        for k, m in members.items())


def _got(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
                   r.ends_sha256) for r in df.collect())


def test_random_conversations(spark):
    r = random.Random(2)
    rows = []
    for c in [*range(0, 120), *range(-12, 0), 10 ** 12]:
        if c % 7 == 3:
            continue
        for t in range(r.randrange(1, 14)):
            rows.append((c, t if r.random() < .95 else None, r.choice(["user", "user", "assistant", None]), r.choice(["a", "b", "\u00e9\u4e00", None, ""])))
    want = _brute(rows)
    assert _got(trie.prefix_trie(_table(spark, rows).repartition(4))) == want
    assert _got(trie.prefix_trie(_table(spark, rows), shard_nodes=8)) == want


def test_a_long_conversation_and_many_equal_ones(spark):
    """Over a stretch of turns, over a stretch of ids, a branch deep in the long one."""
    n = trie.STRETCH
    rows = [(0, t, "user", f"t{t}") for t in range(2 * n + 50)]
    rows += [(10 ** 6, t, "user", f"t{t}") for t in range(2 * n + 10)] + [(10 ** 6, 2 * n + 10, "user", "other")]
    rows += [(c, 0, "user", "same") for c in range(10, 3 * n, 5)]
    assert _got(trie.prefix_trie(_table(spark, rows))) == _brute_deep(rows)


def _brute_deep(rows):
    """As _brute, on chains of digests instead of whole prefixes (all ids are bases)."""
    seq = defaultdict(list)
    for c, _, role, text in rows:
        seq[c].append((role, text))
    members, last, up = defaultdict(list), {}, {}
    end = defaultdict(list)
    for c, s in seq.items():
        k = (0, b"")
        members[k].append(c)
        for d, x in enumerate(s, 1):
            new = (d, hashlib.sha256(k[1] + repr(x).encode()).digest())
            up[new], last[new], k = k, x[1], new
            members[k].append(c)
        end[k].append(c)
    kids = defaultdict(int)
    for k in up:
        kids[up[k]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k in sorted(members, key=lambda k: -k[0]):
        leaves[k] += not kids[k]
        saved[k] += (len(members[k]) - 1) * len(last.get(k, ""))
        if k in up:
            leaves[up[k]] += leaves[k]
            saved[up[k]] += saved[k]
    return sorted((min(m), k[0], min(members[up[k]]) if k in up else -1, len(m), kids[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(end[k]))).encode()).hexdigest()) for k, m in members.items())


def test_slots_are_minimal_and_verified():
    r = np.random.default_rng(1)
    k1, k2 = r.integers(0, 1 << 62, 5000), r.integers(0, 1 << 62, 5000)
    k1[:100], k2[:100] = 7, np.arange(100)  # equal in one half
    table = trie.Slots(k1, k2)
    assert sorted(table.slot) == list(range(5000)) and (table.find(k1, k2) == table.slot).all()
    assert (table.find(k1, k2 + 1)[200:] == -1).all() and len(trie.Slots(k1[:0], k2[:0]).slot) == 0


def test_accumulate_one_shard():
    nodes = pd.DataFrame({"owner": [3, 3, 3, 9], "depth": [1, 2, 3, 2], "k1": [1, 2, 3, 4], "k2": [0, 0, 0, 0], "p1": [0, 1, 2, 1], "p2": [0, 0, 0, 0],
                          "parent": [0.0, 3.0, 3.0, 3.0], "n": [2, 1, 1, 1], "children": [2, 1, 0, 0], "leaves": [1, 0, 1, 1], "saved": [5, 7, 11, 100], "shard": 0})
    out = trie.accumulate(nodes)  # what hangs on another chain is added before, not here
    assert out["leaves"].tolist() == [2, 1, 1, 1] and out["saved"].tolist() == [23, 18, 11, 100]


def test_colliding_digests_start_over(spark, monkeypatch):
    seeds = []

    def bad(rows, whole=trie.distinct_nodes):
        nodes, n = whole(rows)
        seeds.append(n)
        return nodes, 1 if len(seeds) < 3 else n
    monkeypatch.setattr(trie, "distinct_nodes", bad)
    rows = [(0, 0, "user", "a"), (5, 0, "user", "a")]
    assert _got(trie.prefix_trie(_table(spark, rows))) == _brute(rows) and seeds == [0, 0, 0]


def test_a_collision_is_seen(spark):
    rows = spark.createDataFrame([(1, 1, 5, 5, 0, 0, "a", 1, True), (2, 1, 5, 5, 0, 0, "b", 1, True), (3, 1, 6, 6, 0, 0, "c", 1, True)],
                                 "conv bigint, depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, sha string, bytes bigint, last boolean")
    assert trie.distinct_nodes(rows)[1] == 1


def test_edge_rows(spark):
    rows = [(None, 0, "user", "x"), (1, 0, "user", "no base"), (2, 0, None, None), (2, 0, None, None), (5, None, "user", "z" * 300_000), (6, 0, "u", "s"),
            (10, 1, "a", "same"), (10, 1, "a", "same"), (15, 3, "", "aa"), (20, 3, "a", "a")]
    assert _got(trie.prefix_trie(_table(spark, rows))) == _brute(rows)
    assert trie.prefix_trie(_table(spark, [])).count() == 0
    assert trie.prefix_trie(_table(spark, [(None, 1, "a", "b")])).count() == 0
