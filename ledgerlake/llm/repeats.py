"""Exact removal of repeated byte strings across documents by prefix-free parsing.

A byte is removed if a string of ``WIDTH`` bytes covers it that also starts in a
document with a smaller id.

Parsing: a rolling hash of ``GRAM`` bytes triggers a phrase wherever it is the
smallest (leftmost on ties) of the grams of some WIDTH-byte window.  The phrase of
a trigger is the text of all windows that choose it, so equal windows lie in
phrases with the same trigger gram and phrases overlap as a prefix-free parse needs.
A document is its sequence of phrases (the parse); distinct phrases with their
smallest document are the dictionary.

No suffix array is built: equality of WIDTH bytes is all that the removal needs, so phrases
and windows are told apart by hashes, sorted within buckets, and never put into the order of
their bytes.  The steps:

0. *Copies.*  A text that an earlier document holds whole loses everything; only the
   first of equal texts goes on.
1. *Triggers.*  Grams met in one document only can't hold a repeat.  Groups of
   documents deal their distinct gram hashes into buckets, and those met in two
   documents come back to the groups that sent them.
2. *Dictionary.*  Groups send the distinct phrases of repeated triggers with their
   smallest document; buckets sort them and tell which an earlier group has: there
   such a phrase is a repeat as a whole.  Buckets also tell which triggers stand in
   more than one phrase: a trigger with one phrase has its windows nowhere else, so
   nothing is left to ask about it.
3. *Suffixes.*  For the other triggers the first document of each phrase sends the
   phrase's windows (its suffixes, each cut to WIDTH bytes); buckets sort them, and
   those that an earlier document holds within another phrase come back.
4. Each document's repeats are put together from 2 and 3 and cut out.

Every exchange carries packed arrays of hashes, already combined per group of
documents (about ``group_bytes`` of text, dealt by a hash), so a passage that very
many documents share arrives once per group; buckets are sized from the corpus.
The text is shuffled once: the passes over it share one exchange.

Hashes of phrases and windows have 64 bits (with the bucket more), copies are told
by md5; gram hashes have 32 bits beside the bucket, where a collision costs time only.

Defined results: a null text is empty; a document of under WIDTH bytes keeps
everything; equal texts lose all of the later ones; documents with the same id
remove nothing from each other; a null id counts as larger than every id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, corpus_size, mix, stored

#: A gram is a multiple of 8 bytes: longer ones meet less by chance, shorter ones are
#: chosen more sparsely (two in CHOICES + 1 positions).
WIDTH, GRAM = 50, 24
CHOICES = WIDTH - GRAM + 1
LAST_ID = np.iinfo(np.int64).max
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
LOW32 = np.uint64((1 << 32) - 1)
#: Words of 8 bytes that cover a window.
WORDS = (8, 16, 24, 32, 40, WIDTH - 8)
CELL = "bucket int, grp int, a binary, b binary"
ANSWER = "grp int, kind string, bucket int, a binary, b binary"
#: Kinds of what comes back to a group: copies (id, hash of the text), repeated
#: triggers, phrases an earlier group has, triggers of several phrases, windows an
#: earlier document has.
COPY, ALIVE, EARLIER, SEVERAL, HIT = "copy", "alive", "earlier", "several", "hit"


class Parsed:
    """Phrases of a run of documents laid end to end."""

    def __init__(self, raws: list[bytes], ids: list[int]):
        self.raws, self.ids = raws, np.array(ids, np.int64)
        self.ends = np.cumsum([len(r) for r in raws])
        buf = b"".join(raws)
        n = self.n = len(buf)
        self.bytes = np.frombuffer(buf, np.uint8)
        self.anchor = self.lo = self.hi = np.zeros(0, np.int64)
        self.gram = np.zeros(0, np.uint64)
        if n < WIDTH:
            return
        # the 8 bytes at every position, as one number
        self.w8 = np.array(np.ndarray((n,), "<u8", buffer=buf + bytes(8), strides=(1,)))
        x = self.w8[:n - GRAM + 1] * M1
        for off in range(8, GRAM, 8):
            x ^= x >> np.uint64(32)
            x *= M1
            x += self.w8[off:n - GRAM + 1 + off] * M2
        h = mix(x)
        bits = np.uint64(max(20, n.bit_length()))
        low = (np.uint64(1) << bits) - np.uint64(1)
        m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while width * 2 <= CHOICES:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        if width < CHOICES:
            rest = CHOICES - width
            m = np.minimum(m[:-rest], m[rest:])
        valid = np.ones(len(m), bool)
        cross = (self.ends[:, None] - np.arange(1, WIDTH)).ravel()
        valid[cross[(cross >= 0) & (cross < len(m))]] = False
        starts = np.flatnonzero(valid)
        if not len(starts):
            return
        chosen = (m[starts] & low).astype(np.int64)
        first = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)])
        self.lo, self.hi = starts[first], starts[np.r_[first[1:] - 1, len(starts) - 1]]
        self.anchor = chosen[first]
        self.gram = h[self.anchor]

    def triggers(self, buckets: int) -> np.ndarray:
        """Bucket and 32 bits of each phrase's trigger."""
        return (self.gram & LOW32) | (bucket_of(self.gram, buckets).astype(np.uint64) << np.uint64(32))

    def docs(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, side="right")

    def windows(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the windows that start at ``at``."""
        x = self.w8[at]
        for off in WORDS:
            x = (x ^ (x >> np.uint64(29))) * M1 + self.w8[at + off]
        return mix(x)

    def phrases(self, of: np.ndarray) -> np.ndarray:
        """Hashes of phrases: first and last window overlap, so they tell the text."""
        lo, hi = self.lo[of], self.hi[of]
        return mix(self.windows(lo) * M2 + self.windows(hi) + (hi - lo).astype(np.uint64) * M1)


def runs(ids, texts, size: int = 1 << 19) -> Iterator[Parsed]:
    """Documents parsed in runs of about ``size`` bytes (a longer document alone)."""
    raws: list[bytes] = []
    own: list[int] = []
    total = 0
    for i, t in zip(ids, texts):
        raw = as_bytes(t)
        if raws and total + len(raw) > size:
            yield Parsed(raws, own)
            raws, own, total = [], [], 0
        raws.append(raw)
        own.append(i)
        total += len(raw)
    if raws:
        yield Parsed(raws, own)


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def low32(h: np.ndarray) -> bytes:
    return h.astype(np.uint32).tobytes()


def with_bucket(raw: bytes, bucket: int) -> np.ndarray:
    """Bucket and 32 bits as one sortable number, as ``Parsed.triggers`` gives it."""
    return np.frombuffer(raw, np.uint32).astype(np.uint64) | (np.uint64(bucket) << np.uint64(32))


def pack_ids(d: np.ndarray) -> bytes:
    """Ids as offsets of 4 bytes from the smallest, where they fit."""
    low = int(d.min())
    if int(d.max()) - low < 1 << 32:
        return b"4" + np.int64(low).tobytes() + (d - low).astype(np.uint32).tobytes()
    return b"8" + d.tobytes()


def unpack_ids(raw: bytes) -> np.ndarray:
    if raw[:1] == b"4":
        return np.frombuffer(raw, np.uint32, offset=9).astype(np.int64) + np.frombuffer(raw[1:9], np.int64)[0]
    return np.frombuffer(raw, np.int64, offset=1)


def member(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Index of each x in the sorted array, -1 where it is absent."""
    if not len(ordered):
        return np.full(len(x), -1)
    p = np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)
    return np.where(ordered[p] == x, p, -1)


def cells(grp: np.ndarray, key: np.ndarray, extra: np.ndarray, buckets: int, pack) -> Iterator[pd.DataFrame]:
    """Rows of (bucket, grp) from arrays ordered by (grp, key)."""
    cell = grp * buckets + bucket_of(key, buckets)
    at = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, int)
    to = np.r_[at[1:], len(cell)]
    for s in range(0, len(at), 2048):
        part = range(s, min(s + 2048, len(at)))
        both = [pack(key[at[i]:to[i]], extra[at[i]:to[i]]) for i in part]
        yield pd.DataFrame({"bucket": (cell[at[s:s + 2048]] % buckets).astype(np.int32),
                            "grp": (cell[at[s:s + 2048]] // buckets).astype(np.int32),
                            "a": [x[0] for x in both], "b": [x[1] for x in both]})


def joined(parts: list[np.ndarray], kind=np.uint64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def firsts(*ordered: np.ndarray) -> np.ndarray:
    """Where a new value of the (jointly sorted) arrays begins."""
    if not len(ordered[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(ordered[0]) - 1, bool)
    for x in ordered:
        new |= x[1:] != x[:-1]
    return np.flatnonzero(np.r_[True, new])


class Group:
    """A group of documents with what has come back to it."""

    def __init__(self, key: tuple, left: pd.DataFrame, right: pd.DataFrame):
        self.grp = int(key[0])
        self.right = dict(list(right.groupby("kind")))
        copies = self.right.get(COPY)
        gone = {(int(i), int(h)) for i, h in zip(copies["a"], copies["b"])} if copies is not None else set()
        self.copy = [(i, h) in gone for i, h in zip(left["doc_id"], left["hash"])]
        self.first = ~np.array(self.copy, bool)
        self.left = left
        own = left[self.first]
        self.runs = list(runs(own["doc_id"], own["text"]))

    def numbers(self, kind: str, column: str = "a") -> np.ndarray:
        rows = self.right.get(kind)
        return joined([np.frombuffer(x, np.uint64) for x in rows[column]] if rows is not None else [])

    def keys(self, kind: str) -> np.ndarray:
        rows = self.right.get(kind)
        return np.unique(joined([with_bucket(a, k) for a, k in zip(rows["a"], rows["bucket"])] if rows is not None else []))

    def phrases(self) -> list[tuple[Parsed, np.ndarray, np.ndarray, np.ndarray]]:
        """Per run: its phrases, their documents, and whether one before them (in this
        group, or as the answer tells) has the phrase."""
        earlier = np.sort(self.numbers(EARLIER))
        fs = [p.phrases(np.arange(len(p.anchor))) if len(p.anchor) else np.zeros(0, np.uint64) for p in self.runs]
        ds = [p.ids[p.docs(p.anchor)] for p in self.runs]
        f, d = joined(fs), joined(ds, np.int64)
        o = np.lexsort((d, f))
        at = firsts(f[o])
        known, low = f[o][at], d[o][at]
        return [(p, f, d, (d > low[member(f, known)]) | (member(f, earlier) >= 0) if len(f) else np.zeros(0, bool))
                for p, f, d in zip(self.runs, fs, ds)]

    def open_windows(self, buckets: int):
        """Per run: it, where windows start that no earlier phrase answers for, and the
        phrases that are repeats as a whole."""
        several = self.keys(SEVERAL)
        for p, f, d, later in self.phrases():
            rest = np.flatnonzero(~later & (member(p.triggers(buckets), several) >= 0)) if len(several) else np.zeros(0, int)
            yield p, _spread(p.lo[rest], p.hi[rest]) if len(rest) else np.zeros(0, np.int64), np.flatnonzero(later)


def _rows(parts: list[pd.DataFrame]) -> pd.DataFrame:
    parts = [x for x in parts if len(x)]
    empty = pd.DataFrame({"bucket": [], "grp": [], "a": [], "b": []}).astype({"bucket": "int32", "grp": "int32", "a": object, "b": object})
    return pd.concat(parts) if parts else empty


def _send_grams(buckets: int):
    """Distinct grams of a group, and which of them two of its documents share."""
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        group = Group(key, left, right)
        g = joined([p.gram for p in group.runs])
        d = joined([p.ids[p.docs(p.anchor)] for p in group.runs], np.int64)
        o = np.argsort(g, kind="stable")
        g, d = g[o], d[o]
        at = firsts(g)
        several = np.minimum.reduceat(d, at) < np.maximum.reduceat(d, at) if len(at) else np.zeros(0, bool)
        return _rows(list(cells(np.full(len(at), group.grp), g[at], several, buckets,
                                lambda k, x: (low32(k), np.packbits(x).tobytes()))))
    return run


def _answers(pdf: pd.DataFrame, kind: str, a: list[bytes]) -> pd.DataFrame:
    """What each row of a bucket gets back, without empty answers."""
    out = pd.DataFrame({"grp": pdf["grp"].to_numpy(), "kind": kind, "bucket": pdf["bucket"].to_numpy(), "a": a, "b": [b""] * len(a)})
    return out[[len(x) > 0 for x in a]]


def _spans_of(n: np.ndarray):
    end = np.cumsum(n)
    return list(zip(end - n, end))


def _repeated_grams(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the grams of each group that two documents hold."""
    n = np.array([len(a) // 4 for a in pdf["a"]])
    every = joined([np.frombuffer(a, np.uint32) for a in pdf["a"]])
    several = joined([np.unpackbits(np.frombuffer(b, np.uint8), count=k) for b, k in zip(pdf["b"], n)]).astype(np.int64)
    _, of, count = np.unique(every, return_inverse=True, return_counts=True)
    alive = (count + np.bincount(of, several, len(count)) > 1)[of]
    return _answers(pdf, ALIVE, [np.sort(every[s:e][alive[s:e]]).tobytes() for s, e in _spans_of(n)])


def _send_phrases(buckets: int):
    """Distinct phrases of repeated triggers with their smallest document, and, in
    buckets of their own, each such trigger with its phrase (0: several here)."""
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        group = Group(key, left, right)
        alive, fs, ds, gs = group.keys(ALIVE), [], [], []
        for p in group.runs if len(alive) else []:
            of = np.flatnonzero(member(p.triggers(buckets), alive) >= 0)
            if len(of):
                fs.append(p.phrases(of))
                ds.append(p.ids[p.docs(p.anchor[of])])
                gs.append(p.gram[of])
        f, d, g = joined(fs), joined(ds, np.int64), joined(gs)
        o = np.lexsort((d, f))
        at = o[firsts(f[o])]
        out = list(cells(np.full(len(at), group.grp), f[at], d[at], buckets, lambda k, x: (k.tobytes(), pack_ids(x))))
        o = np.lexsort((f, g))
        g, f = g[o], f[o]
        at = firsts(g)
        one = np.where(f[at] == f[np.r_[at[1:], len(f)].astype(np.int64) - 1], f[at], np.uint64(0)) if len(at) else f
        for rows in cells(np.full(len(at), group.grp), g[at], one, buckets, lambda k, x: (low32(k), x.tobytes())):
            out.append(rows.assign(bucket=(rows["bucket"] + buckets).astype(np.int32)))
        return _rows(out)
    return run


def _answer_phrases(buckets: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[0] < buckets:
            return _answer_smaller(pdf, EARLIER)
        pdf = pdf.assign(bucket=pdf["bucket"] - buckets)
        n = np.array([len(a) // 4 for a in pdf["a"]])
        g = joined([np.frombuffer(a, np.uint32) for a in pdf["a"]])
        f = joined([np.frombuffer(b, np.uint64) for b in pdf["b"]])
        o = np.argsort(g, kind="stable")
        at = firsts(g[o])
        low = np.minimum.reduceat(f[o], at)
        several = (low < np.maximum.reduceat(f[o], at)) | (low == 0)
        flag = np.empty(len(g), bool)
        flag[o] = np.repeat(several, np.diff(np.r_[at, len(g)]))
        return _answers(pdf, SEVERAL, [g[s:e][flag[s:e]].tobytes() for s, e in _spans_of(n)])
    return run


def _answer_smaller(pdf: pd.DataFrame, kind: str) -> pd.DataFrame:
    """Of one bucket: the hashes of each group that come with a smaller document in
    another row, with the document they were sent with."""
    h = joined([np.frombuffer(a, np.uint64) for a in pdf["a"]])
    d = joined([unpack_ids(b) for b in pdf["b"]], np.int64)
    o = np.argsort(h, kind="stable")
    at = firsts(h[o])
    smallest = np.empty(len(h), np.int64)
    smallest[o] = np.repeat(np.minimum.reduceat(d[o], at), np.diff(np.r_[at, len(h)]))
    hit = smallest < d
    spans = _spans_of(np.array([len(a) // 8 for a in pdf["a"]]))
    if kind == HIT:
        h = mix(h + d.astype(np.uint64) * M1)
    return _answers(pdf, kind, [h[s:e][hit[s:e]].tobytes() for s, e in spans])


def _answer_windows(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    return _answer_smaller(pdf, HIT)


def _spread(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of the ranges lo..hi (inclusive)."""
    n = hi - lo + 1
    return np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)


def _send_windows(buckets: int):
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        group, hs, ds = Group(key, left, right), [], []
        for p, at, _ in group.open_windows(buckets):
            if len(at):
                hs.append(p.windows(at))
                ds.append(p.ids[p.docs(at)])
        h, d = joined(hs), joined(ds, np.int64)
        o = np.lexsort((d, h))
        at = o[firsts(h[o], d[o])]
        return _rows(list(cells(np.full(len(at), group.grp), h[at], d[at], WINDOW_BUCKETS * buckets,
                                lambda k, x: (k.tobytes(), pack_ids(x)))))
    return run


def _cut(buckets: int):
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        group = Group(key, left, right)
        hits = np.sort(group.numbers(HIT))
        found = []
        for p, at, later in group.open_windows(buckets):
            lo, hi = p.lo[later], p.hi[later] + WIDTH
            if len(at) and len(hits):
                of = mix(p.windows(at) + p.ids[p.docs(at)].astype(np.uint64) * M1)
                at = at[member(of, hits) >= 0]
                lo, hi = np.r_[lo, at], np.r_[hi, at + WIDTH]
            gone = np.bincount(lo, minlength=p.n + 1) - np.bincount(hi, minlength=p.n + 1)
            mask = (np.cumsum(gone) > 0)[:-1]
            for raw, e in zip(p.raws, p.ends):
                own = mask[e - len(raw):e]
                if own.any():
                    edge = np.diff(np.r_[0, own.astype(np.int8), 0])
                    found.append((len(raw), np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(),
                                  p.bytes[e - len(raw):e][~own].tobytes()))
                else:
                    found.append((len(raw), [], [], raw))
        rest = iter(found)
        out = []
        for copy, text in zip(group.copy, left["text"]):
            raw = as_bytes(text)
            out.append(next(rest) if not copy else (len(raw), [], [], raw) if len(raw) < WIDTH else (len(raw), [0], [len(raw)], b""))
        return pd.DataFrame({"row": left["row"], "n_bytes": [x[0] for x in out], "starts": [x[1] for x in out],
                             "ends": [x[2] for x in out], "kept": [x[3] for x in out]})
    return run


WINDOW_BUCKETS = 4
RESULT = "row bigint, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary"


def cut_repeats(docs: DataFrame, *, row_col: str = "doc_id", id_col: str = "doc_id", text_col: str = "text",
                group_bytes: int = 4 << 20, bucket_bytes: int = 2 << 20) -> DataFrame:
    """One row per document row: ``row`` (the value of ``row_col``), ``n_bytes``, the
    removed byte runs ``starts`` and ``ends``, and ``kept``, the bytes that are left."""
    _, size = corpus_size(docs, text_col)
    groups = max(1, -(-size // group_bytes))
    buckets = max(1, -(-size * 8 // CHOICES // bucket_bytes))
    text = F.col(text_col).cast("binary")
    src = docs.select(F.col(row_col).cast("long").alias("row"),
                      F.coalesce(F.col(id_col).cast("long"), F.lit(int(LAST_ID))).alias("doc_id"), text.alias("text"),
                      F.xxhash64(text).alias("hash"), F.md5(text).alias("md5"))
    src = src.withColumn("grp", F.pmod(F.xxhash64("doc_id", "row"), F.lit(groups)).cast("int"))
    # Equal texts after the first; stored, so that the join gets exchanges of its own.
    whole = src.where(F.octet_length("text") >= WIDTH).select("grp", "doc_id", "hash", "md5")
    equal = stored(whole.groupBy("md5").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                   .where("first < last").select("md5", "first"), "equal")
    copies = stored(whole.join(equal, "md5").where("doc_id > first").select(
        "grp", F.lit(COPY).alias("kind"), F.lit(0).alias("bucket"), F.col("doc_id").cast("string").cast("binary").alias("a"),
        F.col("hash").cast("string").cast("binary").alias("b")), "copies")
    grouped = src.select("row", "doc_id", "text", "hash", "grp").groupBy("grp")

    def ask(function, schema: str, *answers: DataFrame) -> DataFrame:
        back = copies
        for x in answers:
            back = back.unionByName(x)
        return grouped.cogroup(back.groupBy("grp")).applyInPandas(function, schema)

    def answer(asked: DataFrame, function) -> DataFrame:
        return asked.groupBy("bucket").applyInPandas(function, ANSWER)

    alive = answer(ask(_send_grams(buckets), CELL), _repeated_grams)
    phrases = answer(ask(_send_phrases(buckets), CELL, alive), _answer_phrases(buckets))
    windows = answer(ask(_send_windows(buckets), CELL, phrases), _answer_windows)
    return ask(_cut(buckets), RESULT, phrases, windows)


def digest(cut: DataFrame) -> DataFrame:
    return cut.select(F.col("row").alias("doc_id"), "n_bytes",
                      (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def whole_characters(text, starts, ends):
    """A text without its removed runs, each run shrunk to whole characters."""
    if text is None or starts is None or not len(starts):
        return text
    raw = as_bytes(text)
    out, last = [], 0
    for a, b in zip(starts, ends):
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        out.append(raw[last:a])
        last = b
    out.append(raw[last:])
    return b"".join(out).decode("utf-8", "replace")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs``, all columns and rows, with repeated strings cut out of the texts.
    Reads ``docs`` twice by row number, so ``docs`` must be a table, not a plan whose
    row order can change."""
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    cut = cut_repeats(numbered, row_col="_row", id_col=id_col, text_col=text_col, **kw).where(F.size("starts") > 0)
    cut = cut.select(F.col("row").alias("_row"), F.col("starts").alias("_s"), F.col("ends").alias("_e"))

    @F.pandas_udf("string")
    def without(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([whole_characters(*x) for x in zip(texts, starts, ends)], dtype=object)

    return numbered.join(cut, "_row", "left").withColumn(text_col, without(text_col, "_s", "_e")).select(*docs.columns)


SQL = """
with d as materialized (select doc_id, lower(hex(encode(coalesce(text, '')))) as h from documents),
-- blocks that overlap, so that no substring is looked up in a long text
k as materialized (
  select doc_id, o, substr(h, cast(2 * o + 1 as bigint), 2146) as t from d, unnest(range(0, greatest(len(h) // 2, 1), 1024)) as u(o)),
w as materialized (
  select doc_id, o + p as p, substr(t, cast(2 * p + 1 as bigint), 100) as s
  from k, unnest(range(0, least(1024, len(t) // 2 - 49))) as u(p) where len(t) >= 100),
m as (select s, min(doc_id) as first from w group by s having min(doc_id) < max(doc_id)),
hit as materialized (select w.doc_id, w.p from w join m using (s) where m.first < w.doc_id),
b as (
  select k.doc_id, o + u.p as p, substr(t, cast(2 * u.p + 1 as bigint), 2) as x
  from k semi join hit on hit.doc_id = k.doc_id, unnest(range(0, least(1024, len(t) // 2))) as u(p)),
c as (
  select b.doc_id, b.p, x, max(hit.p) over (partition by b.doc_id order by b.p rows between 49 preceding and current row) is not null as gone
  from b left join hit on hit.doc_id = b.doc_id and hit.p = b.p),
e as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by p), false) as begins from c),
r as (
  select doc_id, count(*) filter (gone) as n_removed, count(*) filter (begins) as n_spans,
         coalesce(string_agg(x, '' order by p) filter (not gone), '') as kept
  from e group by doc_id)
select d.doc_id, cast(len(h) // 2 as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed,
       coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, h))) as kept_sha256
from d left join r using (doc_id)
"""
