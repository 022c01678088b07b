"""The registered queries against SQL, brute force, held-out rows and round trips."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import extract, lm, minhash, repeats, sentencepieces, sharding
from ledgerlake.llm.common import components, words_of
from ledgerlake.llm.queries import ORACLE_SQL, QUERIES
from parity import _rows, duck, spark_type

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    rel = duck(SF).sql(ORACLE_SQL[name])
    assert {f.name: spark_type(f.dataType) for f in df.schema.fields} == dict(zip(rel.columns, map(str, rel.types)))
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (500, 499)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[i] == 100 for i in range(100, 140)) and got[500] == got[499] == 499


def test_near_duplicates_of_a_dense_group(spark):
    """Copies of one text with few edits each: links that only copies share are kept."""
    r = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(160):
        t = list(base)
        for at in r.choice(150, int(r.integers(0, 9)), replace=False):
            t[at] = f"e{r.integers(10 ** 6)}"
        texts.append(" ".join(t))
    sets = [{tuple(t.split()[i:i + 4]) for i in range(147)} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(
        spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), words=4).collect()}
    assert [got[i] for i in range(len(texts))] == root


def test_repeats_in_small_groups_equal_brute_force(spark):
    """Many groups and buckets, repeats within and across documents, runs of one byte."""
    r = np.random.default_rng(5)
    pool = ["".join(r.choice(list("abcé "), 70)) for _ in range(12)] + ["a" * 120, "ab" * 60]
    rows = [(i, "".join(pool[k] if k < len(pool) else "".join(r.choice(list("xyz "), 40)) for k in r.integers(0, 20, 6)))
            for i in range(60)]
    first: dict[bytes, int] = {}
    raws = [(i, t.encode()) for i, t in rows]
    for i, b in raws:
        for p in range(len(b) - 49):
            first.setdefault(b[p:p + 50], i)
    want = {}
    for i, b in raws:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone[p:p + 50] = True
        want[i] = np.frombuffer(b, np.uint8)[~gone].tobytes()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {x.row: bytes(x.kept) for x in repeats.cut_repeats(docs, group_bytes=2000, bucket_bytes=300).collect()}
    assert got == want


def test_growing_moves_rows_into_the_new_shard_only(spark):
    moved = QUERIES["op5_sharding"](spark, SF).where("grown_shard <> shard")
    assert {r.grown_shard for r in moved.collect()} <= {24}
    leaves = sharding.tree(24)
    heavier = [(a, b, c, w * (2 if c == 5 else 1)) for a, b, c, w in leaves]
    df = sharding.assign(sharding.assign(spark.range(5000), "id", leaves, "s"), "id", heavier, "t")
    # only the rack of the heavier shard, its region and what they draw in may change
    assert df.where("s <> t and floor(t / 8) <> 0").count() == 0


def test_lm_base_counts_and_probabilities(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    c = Counter()
    for d in docs:
        if zlib.crc32(str(d.doc_id).encode()) % 7 != 2:
            c.update([*words_of(d.text), lm.END_WORD])
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in QUERIES["op9_lm_scoring"](spark, SF).collect()}
    for d in docs:
        w = [*words_of(d.text), lm.END_WORD]
        r = got[d.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 7 == 2)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


class Automaton:
    """The model in plain dictionaries, one text at a time."""

    def __init__(self, counts: np.ndarray, total: int, two: dict[int, int], three: dict[int, int]):
        """counts: of each word, and of beginnings last; two, three: n-grams by key."""
        k = self.k = len(counts)
        self.unigram = (counts[:-1] + 1.0) / (total + k - 1)
        contexts: dict[tuple, list] = {}
        for key, n in two.items():
            contexts.setdefault((key // k,), []).append((key % k, n))
        for key, n in three.items():
            contexts.setdefault((key // (k * k), key // k % k), []).append((key % k, n))
        self.states = {(): 0}
        self.last, self.fail, self.back, self.arcs = [-1], [0], [1.0], {}
        for context in sorted(contexts, key=lambda c: (len(c), c)):
            s = len(self.last)
            size = two[context[0] * k + context[1]] if len(context) == 2 else int(counts[context[0]])
            self.states[context] = s
            self.last.append(context[-1])
            self.fail.append(self.states.get(context[1:], 0))
            self.back.append(1 - sum(n - lm.DISCOUNT for _, n in contexts[context]) / size)
            for w, n in contexts[context]:
                self.arcs[s * k + w] = (n - lm.DISCOUNT) / size
        self.start = self.states.get((k - 1,), 0)

    def share(self, state: int, w: int) -> float:
        if not state:
            return float(self.unigram[w])
        return self.arcs.get(state * self.k + w, 0.0) + self.back[state] * self.share(self.fail[state], w)

    def probability(self, state: int, w: int) -> float:
        """log10 probability of a word after a context."""
        return math.log10(self.share(state, w))

    def score(self, words: list[int]) -> float:
        """One traversal: the state is carried, log-probabilities are added."""
        total, state = 0.0, self.start
        for w in words:
            total += self.probability(state, w)
            state = self.states.get((self.last[state], w)) or self.states.get((w,), 0)
        return total


def test_automaton_states_are_distributions():
    counts = np.array([50, 10, 30, 20, 10])  # rare, end, two words, beginnings
    k = 5
    two = {2 * k + 3: 12, 2 * k + 1: 4, 3 * k + 2: 9, 4 * k + 2: 6}
    a = Automaton(counts, 110, two, {(2 * k + 3) * k + 2: 7})
    for state in range(len(a.last)):
        assert sum(10 ** a.probability(state, w) for w in range(k - 1)) == pytest.approx(1)
    assert a.score([2, 3, 2, 1]) == pytest.approx(
        a.probability(a.states[(4,)], 2) + a.probability(a.states[(2,)], 3) + a.probability(a.states[(2, 3)], 2) + a.probability(a.states[(2,)], 1))


def test_lm_keeps_every_ngram(spark):
    """Scores of groups that ask each other equal one automaton over all words."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(150)
    rows = [(d.doc_id, [*words_of(d.text), lm.END_WORD]) for d in docs.collect()]
    learned = [w for i, w in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    number = {w: i + 1 for i, w in enumerate(sorted({x for w in learned for x in w}))}  # 0: unknown
    k = len(number) + 2
    counts, two, three = np.zeros(k, int), Counter(), Counter()
    for w in learned:
        c = [k - 1, *(number[x] for x in w)]
        np.add.at(counts, c, 1)
        two.update(a * k + b for a, b in zip(c, c[1:]))
        three.update((x * k + y) * k + z for x, y, z in zip(c, c[1:], c[2:]))
    automaton = Automaton(counts, int(counts[:-1].sum()), two, three)
    got = {r.doc_id: r.score for r in lm.score_documents(docs.repartition(3), group_bytes=20_000, bucket_bytes=50_000).collect()}
    for i, w in rows:
        assert got[i] == pytest.approx(automaton.score([number.get(x, 0) for x in w]), rel=1e-9)


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = QUERIES["op6_toxicity"](spark, sf).where("held_out").join(labels, "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in held.groupBy("toxic", "predicted").count().collect()}
    right, all_ = sum(v for (y, p), v in n.items() if y == p), sum(n.values())
    assert right / all_ > 0.97 and n.get((1, 1), 0) > 0.85 * sum(v for (y, _), v in n.items() if y == 1)


def _viterbi(p: sentencepieces.Pieces, text: str, pieces: dict[str, int]) -> list[int]:
    """Unigram Viterbi over characters, one text at a time."""
    m = sentencepieces.MARK + text.replace(" ", sentencepieces.MARK)
    best: list = [(0.0, [])] + [None] * len(m)
    for s in range(len(m)):
        single = False
        for e in range(s + 1, min(len(m), s + 20) + 1):
            i = pieces.get(m[s:e])
            if i is not None:
                single |= e == s + 1
                if best[e] is None or best[s][0] + p.scores[i] > best[e][0]:
                    best[e] = (best[s][0] + p.scores[i], [*best[s][1], i])
        if not single and (best[s + 1] is None or best[s][0] + p.unknown_score > best[s + 1][0]):
            best[s + 1] = (best[s][0] + p.unknown_score, [*best[s][1], *(int(p.byte_id[b]) for b in m[s].encode())])
    return best[-1][1]


def test_sentencepieces_equal_brute_force_and_round_trip(spark):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    p = sentencepieces.Pieces.load(sentencepieces.MODEL)
    ids = {model.id_to_piece(i): i for i in range(model.vocab_size())
           if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    texts = [r.text[:70] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    texts += ["  a  b ", "日本語 ñ😀", "\x00\x01", "tab\tand\nline", " ", "x" * 90]
    for t, got in zip(texts, sentencepieces.Encoder(p).encode(texts)):
        assert got.tolist() == _viterbi(p, t, ids)
        assert p.decode(got.tolist()) == t
    assert QUERIES["op3_sentencepiece"](spark, SF).where("not round_trip").count() == 0


def test_pages_equal_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in QUERIES["op8_html_extraction"](spark, SF).collect()}
    for r in pages.collect():
        assert got[r.page_id] == "\n".join(b[1] for b in extract.blocks(r.html) if extract.taught(b[0]))


def test_licences_equal_brute_force(spark):
    import re
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op2_license_scan"](spark, SF).collect()}
    assert len(got) == len(docs)
    named = {"MIT License": "MIT", "Apache License": "Apache-2.0", "GNU General Public License, version 3": "GPL-3.0", "CC BY-NC": "CC-BY-NC-4.0"}
    for d in docs:
        told = {v for k, v in named.items() if re.search(rf"^.*(?:licensed under|released under).*{re.escape(k)}", d.text, re.I | re.M)}
        r = got[d.doc_id]
        assert (r.how == "header") == bool(told), d.doc_id
        if told:
            assert r.license in told


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


#: Keys without SQL, and the test here that stands for it.
BY_TEST = {"op3_sentencepiece": test_sentencepieces_equal_brute_force_and_round_trip,
           "op6_toxicity": test_toxicity_on_held_out_labels, "op8_html_extraction": test_pages_equal_their_articles,
           "op9_lm_scoring": test_lm_keeps_every_ngram}


def test_every_query_has_sql_or_a_test():
    assert set(QUERIES) - set(ORACLE_SQL) == set(BY_TEST)
