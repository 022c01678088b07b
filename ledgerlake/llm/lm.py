"""Language-model scores by a weighted backoff automaton over word trigrams.

*Tokens* are words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, then one end.

*Model.*  Every word, bigram and trigram of the training texts is kept with its whole
count; no word is classed, no n-gram dropped.  The model is an automaton: its states are
the contexts, a seen n-gram is an arc from its context that carries the log-probability of
its last word (discounted by ``DISCOUNT``, interpolated with the shorter context's), and a
state's failure arc goes to the context without its first word and carries the log of
``DISCOUNT * successors / count``; so each state's probabilities sum to one.  The empty
context, whose arcs are add-one shares of all known tokens and one unknown, fails nowhere.

*Groups.*  Texts are packed, partition by partition, into groups of about
``group_bytes`` as arrays of word numbers, in a table bucketed by group, so that no round
shuffles them.  In each round a group deals its distinct
keys, with their training counts in it, into buckets of their hashes; buckets add up
and send the totals back in the order of the keys.  Rounds: words, bigrams, trigrams
and successors of words, successors of bigrams.  Nothing is sent anywhere whole.

*What need not be asked.*  Buckets tell a group which words and bigrams no other group
has; every n-gram that holds one is in that group only, which counts it itself, exactly.

*Scoring.*  A group builds the states, arcs and failure arcs of its own texts from the totals
(``Arcs``) and runs each text through them from left to right: the state of the two words
before, its arc if there is one, else the failure arc and the next state's.

*Disk.*  What is sent is sorted and cut into byte planes, whose upper ones compress away; after
each round the driver lets go of the round's shuffles, which then are deleted.

Defined results: a null text is empty and has the end as its only token; rows with a
null id are scored and not learned from; equal texts have equal scores; with nothing
to learn from all counts are 0.  Tokens and n-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, bucketed, corpus_size, mix, reclaim, ship, stored, word_hash, words_of
from .repeats import M1, M2, bucket_of, firsts, joined

DISCOUNT = 0.75
#: No word holds a space.
END_WORD = b" end"
END_HASH, BEGIN_HASH = np.uint64(word_hash(END_WORD)), np.uint64(word_hash(b" begin"))
#: Rounds: what a group asks about.
WORDS, PAIRS, TRIPLES, AFTER_WORD, AFTER_PAIR = "words", "pairs", "triples", "after word", "after pair"
GROUP = "grp bigint, ids binary, nulls binary, learn binary, lens binary, words binary, tokens binary"
CELL = "kind string, bucket int, grp bigint, a binary, b binary"
REPLY = "grp bigint, kind string, bucket int, b binary, n bigint, first bigint"


def planes(n: np.ndarray) -> bytes:
    """Numbers byte by byte of their places, so that equal high bytes lie together."""
    return np.ascontiguousarray(n.view(np.uint8).reshape(len(n), n.itemsize).T).tobytes()


def unplaned(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def narrow(n: np.ndarray) -> bytes:
    """Numbers from 0 up in as many bytes each as the largest needs, named in front."""
    kind = np.min_scalar_type(int(n.max(initial=0)))
    return bytes([kind.itemsize]) + planes(n.astype(kind))


def wide(raw: bytes) -> np.ndarray:
    return unplaned(raw[1:], f"u{raw[0]}").astype(np.int64)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and which of them each key is; by hashing, so that only
    distinct keys are sorted."""
    at, found = pd.factorize(keys)
    order = np.argsort(found)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return found[order], rank[at]


def steps(h: np.ndarray) -> bytes:
    """Ascending hashes by their differences."""
    return planes(np.diff(h, prepend=np.uint64(0)))


def unstepped(raw: bytes) -> np.ndarray:
    return np.cumsum(unplaned(raw, "u8"), dtype=np.uint64)


def _pack(group_bytes: int):
    """Texts as groups of word numbers."""
    def packed(grp: int, docs: list, hashes: list[np.ndarray]) -> pd.DataFrame:
        at, words = pd.factorize(np.concatenate(hashes))
        often = np.argsort(-np.bincount(at), kind="stable")  # frequent words have small numbers
        rank = np.empty(len(often), np.int64)
        rank[often] = np.arange(len(often))
        null = np.array([d[0] is None for d in docs])
        return pd.DataFrame({
            "grp": [grp], "ids": [np.array([d[0] or 0 for d in docs], np.int64).tobytes()], "nulls": [null.tobytes()],
            "learn": [np.array([d[1] for d in docs], bool).tobytes()],
            "lens": [np.array([len(h) for h in hashes], np.int64).tobytes()], "words": [words[often].tobytes()], "tokens": [narrow(rank[at])]})

    def run(batches):
        seen, docs, hashes, size = WordHashes(), [], [], 0
        grp = TaskContext.get().partitionId() << 32
        for b in batches:
            for i, learn, t in zip(b["doc_id"], b["learn"], b["text"]):
                if size + len(t or b"") > group_bytes and docs:
                    yield packed(grp, docs, hashes)
                    grp, docs, hashes, size = grp + 1, [], [], 0
                docs.append((None if pd.isna(i) else int(i), bool(learn)))
                hashes.append(seen.of([*words_of(t), END_WORD]))
                size += len(t or b"")
        if docs:
            yield packed(grp, docs, hashes)
    return run


@dataclass
class Arcs:
    """Log10 weights.  States of one word and of two (``state1``, ``state2``: whether there
    is one), their failure arcs, and the arcs of the root and of both kinds (nan: none)."""
    root: np.ndarray
    state1: np.ndarray
    state2: np.ndarray
    fail1: np.ndarray
    fail2: np.ndarray
    arc2: np.ndarray
    arc3: np.ndarray


class Group:
    """A group of texts with what has come back to it."""

    def __init__(self, row, replies: pd.DataFrame | None = None):
        self.grp = int(row["grp"])
        self.replies = {k: r.sort_values("bucket") for k, r in replies.groupby("kind")} if replies is not None else {}
        word = np.frombuffer(row["words"], np.uint64)
        order = np.argsort(word)
        number = np.empty(len(word), np.int64)
        number[order] = np.arange(len(word))
        word = word[order]
        k = self.k = len(word)
        self.word = np.r_[word, BEGIN_HASH]
        self.end = int(np.searchsorted(word, END_HASH))
        self.lens = np.frombuffer(row["lens"], np.int64)
        self.at = np.cumsum(self.lens) - self.lens
        self.docs_learn = np.frombuffer(row["learn"], bool)
        self.learn = np.repeat(self.docs_learn, self.lens)
        self.w = number[wide(row["tokens"])]
        self.n1 = np.bincount(self.w[self.learn], minlength=k)

    def reply(self, kind: str, order: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all keys: totals, whether this group is the first that learns from them,
        and whether no other group has them, as with those not asked about (not in
        ``order``)."""
        total, first, alone = own.copy(), own > 0, np.ones(len(own), bool)
        got = self.replies.get(kind)
        x = joined([wide(b) for b in got["b"]] if got is not None else [], np.int64)
        total[order], alone[order], first[order] = x >> 2, (x & 2) > 0, (x & 1) > 0
        return total, first, alone

    def asked(self, kind: str, hashes: np.ndarray, where: np.ndarray) -> np.ndarray:
        """The keys that the group asks about, in order of their hashes."""
        at = np.flatnonzero(where)
        return at[np.argsort(hashes[at], kind="stable")]

    def words(self) -> None:
        order = np.arange(self.k)  # hashes are sorted already
        total, _, alone = self.reply(WORDS, order, self.n1)
        # a beginning is as frequent as an end
        self.t1, self.alone1 = np.r_[total, total[self.end]], np.r_[alone, alone[self.end]]

    def pairs(self) -> None:
        self.words()
        v = np.r_[0, self.w[:-1]]
        v[self.at] = self.k
        self.v = v
        self.key2, self.p = distinct(v * self.k + self.w)
        self.v2, self.w2 = self.key2 // self.k, self.key2 % self.k
        self.h2 = mix(mix(self.word[self.v2] * M1) + self.word[self.w2] * M2)
        self.n2 = np.bincount(self.p[self.learn], minlength=len(self.key2))
        self.ask2 = self.asked(PAIRS, self.h2, ~(self.alone1[self.v2] | self.alone1[self.w2]))

    def triples(self) -> None:
        self.pairs()
        self.t2, self.first2, self.alone2 = self.reply(PAIRS, self.ask2, self.n2)
        self.inner = np.ones(len(self.w), bool)
        self.inner[self.at] = False
        i = np.flatnonzero(self.inner)
        key, self.q = distinct(self.p[i - 1] * self.k + self.w[i])
        self.c3, w3 = key // self.k, key % self.k
        self.h3 = mix(mix(self.h2[self.c3] * M1) + self.word[w3] * M2)
        self.n3 = np.bincount(self.q[self.learn[i]], minlength=len(key))
        shorter = np.searchsorted(self.key2, self.w2[self.c3] * self.k + w3)
        self.ask3 = self.asked(TRIPLES, self.h3, ~(self.alone2[self.c3] | self.alone2[shorter]))
        self.after1 = np.bincount(self.v2, self.first2, self.k + 1).astype(np.int64)
        self.ask_after1 = self.asked(AFTER_WORD, self.word, ~self.alone1)

    def successors(self) -> None:
        self.triples()
        self.t3, first3, _ = self.reply(TRIPLES, self.ask3, self.n3)
        self.after1 = self.reply(AFTER_WORD, self.ask_after1, self.after1)[0]
        self.after2 = np.bincount(self.c3, first3, len(self.key2)).astype(np.int64)
        self.ask_after2 = self.asked(AFTER_PAIR, self.h2, ~self.alone2 & (self.w2 != self.end))

    def arcs(self, total: int, words: int) -> Arcs:
        """The automaton of this group's n-grams, from the totals over all groups."""
        self.successors()
        after2 = self.reply(AFTER_PAIR, self.ask_after2, self.after2)[0]
        root = (self.t1 + 1.0) / (total + words + 1)

        def seen(n, of, back, shorter):
            return np.log10(np.maximum(n - DISCOUNT, 0) / np.maximum(of, 1) + back * shorter, where=n > 0, out=np.full(len(n), np.nan))
        back1 = DISCOUNT * self.after1 / np.maximum(self.t1, 1)
        back2 = DISCOUNT * after2 / np.maximum(self.t2, 1)
        share2 = np.maximum(self.t2 - DISCOUNT, 0) / np.maximum(self.t1[self.v2], 1) + back1[self.v2] * root[self.w2]
        share2 = np.where(self.t1[self.v2] > 0, share2, root[self.w2])  # of every bigram here, seen or not
        short3 = np.empty(len(self.t3))
        short3[self.q] = share2[self.p[self.inner]]
        state1, state2 = self.t1 > 0, self.t2 > 0
        return Arcs(root=np.log10(root), state1=state1, state2=state2,
                    fail1=np.log10(back1, where=back1 > 0, out=np.zeros(len(back1))), fail2=np.log10(back2, where=back2 > 0, out=np.zeros(len(back2))),
                    arc2=seen(self.t2, self.t1[self.v2], back1[self.v2], root[self.w2]),
                    arc3=seen(self.t3, self.t2[self.c3], back2[self.c3], short3))

    def score(self, total: int, words: int) -> tuple[np.ndarray, ...]:
        """Tokens, known tokens, base score and score of each text."""
        arcs = self.arcs(total, words)
        base = arcs.root[self.w]
        # from the state of one word: its arc, or its failure arc and the root's
        p = np.where(np.isnan(arcs.arc2[self.p]), np.where(arcs.state1[self.v], arcs.fail1[self.v], 0.0) + base, arcs.arc2[self.p])
        # from the state of two words, where there is one: its arc, or its failure arc and the above
        i = np.flatnonzero(self.inner)
        state = self.p[i - 1]
        longer = np.where(np.isnan(arcs.arc3[self.q]), arcs.fail2[state] + p[i], arcs.arc3[self.q])
        p[i] = np.where(arcs.state2[state], longer, p[i])
        known = (self.t1[self.w] > 0).astype(np.int64)
        return self.lens, np.add.reduceat(known, self.at), np.add.reduceat(base, self.at), np.add.reduceat(p, self.at)

    def cells(self, kind: str, hashes: np.ndarray, n: np.ndarray, order: np.ndarray, buckets: int) -> pd.DataFrame:
        h, n = hashes[order], n[order]
        bucket = bucket_of(h, buckets)
        at = firsts(bucket)
        to = np.r_[at[1:], len(h)]
        return pd.DataFrame({"kind": kind, "bucket": bucket[at].astype(np.int32), "grp": np.int64(self.grp),
                             "a": [steps(h[s:e]) for s, e in zip(at, to)], "b": [narrow(n[s:e]) for s, e in zip(at, to)]})


def _ask_words(buckets: int):
    def run(batches):
        for b in batches:
            for _, row in b.iterrows():
                g = Group(row)
                yield g.cells(WORDS, g.word, g.n1, np.arange(g.k), buckets)
    return run


def _ask(kind: str, buckets: int):
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        g = Group(left.iloc[0], right)
        if kind == PAIRS:
            g.pairs()
            return g.cells(PAIRS, g.h2, g.n2, g.ask2, buckets)
        if kind == TRIPLES:
            g.triples()
            return pd.concat([g.cells(TRIPLES, g.h3, g.n3, g.ask3, buckets),
                              g.cells(AFTER_WORD, g.word, g.after1, g.ask_after1, buckets)])
        g.successors()
        return g.cells(AFTER_PAIR, g.h2, g.after2, g.ask_after2, buckets)
    return run


def _total(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Adds up a bucket.  Each group's totals, four times, plus two where no other group
    has the key, plus one where it is the first that learns from it."""
    pdf = pdf.sort_values("grp")
    parts = [unstepped(a) for a in pdf["a"]]
    h, n = joined(parts), joined([wide(b) for b in pdf["b"]], np.int64)
    o = np.argsort(h, kind="stable")
    at = firsts(h[o])
    size = np.diff(np.r_[at, len(h)])
    total = np.repeat(np.add.reduceat(n[o], at), size)
    learns = n[o] > 0
    before = np.cumsum(learns) - learns
    first = learns & (before == np.repeat(before[at], size))
    out = np.empty(len(h), np.int64)
    out[o] = 4 * total + 2 * np.repeat(size == 1, size) + first
    cut = np.cumsum([len(x) for x in parts])
    rows = list(zip(np.split(out, cut[:-1]), np.split(n, cut[:-1])))
    return pd.DataFrame({"grp": pdf["grp"].to_numpy(), "kind": key[0], "bucket": np.int32(key[1]), "b": [narrow(x) for x, _ in rows],
                         "n": [int(y.sum()) for _, y in rows], "first": [int((x & 1).sum()) for x, _ in rows]})


def _score(total: int, words: int):
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0]
        tokens, known, base, score = Group(row, right).score(total, words)
        ids = pd.array(np.frombuffer(row["ids"], np.int64), "Int64")
        ids[np.frombuffer(row["nulls"], bool)] = pd.NA
        return pd.DataFrame({"doc_id": ids, "n_tokens": tokens, "n_known": known, "base_score": base, "score": score})
    return run


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", parts: int = 7, held_part: int = 2,
                    group_bytes: int = 4 << 20, bucket_bytes: int = 16 << 20) -> DataFrame:
    """One row per document row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score."""
    ship(docs.sparkSession)
    _, size = corpus_size(docs, text_col)
    buckets = max(1, -(-size // bucket_bytes))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts
    learn = F.coalesce(part != held_part, F.lit(False))
    packed = src.select("doc_id", learn.alias("learn"), "text").mapInPandas(_pack(group_bytes), GROUP)
    # a few groups to a bucket; 100,000 buckets are the most that Spark allows
    groups = bucketed(packed, "groups", "grp", min(max(1, -(-size // (4 * group_bytes))), 100_000))

    def totals(cells: DataFrame, name: str) -> DataFrame:
        return stored(cells.groupBy("kind", "bucket").applyInPandas(_total, REPLY), name)

    replies = totals(groups.mapInPandas(_ask_words(buckets), CELL), "words")
    reclaim(docs.sparkSession)
    r = replies.agg(F.sum("n").alias("n"), F.sum("first").alias("v")).first()
    total, words = r["n"] or 0, r["v"] or 0
    grouped = groups.groupBy("grp")
    for kind in (PAIRS, TRIPLES, AFTER_PAIR):
        asked = grouped.cogroup(replies.groupBy("grp")).applyInPandas(_ask(kind, buckets), CELL)
        replies = replies.unionByName(totals(asked, kind.replace(" ", "-")))
        del asked
        reclaim(docs.sparkSession)
    scores = grouped.cogroup(replies.groupBy("grp")).applyInPandas(
        _score(total, words), "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == held_part, F.lit(False))
    return scores.select("doc_id", held.alias("held_out"), "n_tokens", "n_known",
                         F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
