"""Near-duplicate documents: MinHash with banding, signature verification, exact
confirmation and connected components.

1. Every text becomes its set of distinct k-word shingles (64-bit hashes of word
   hashes), ``BANDS * ROWS`` universal hash minima of it, one hash per band and one
   byte per minimum.
2. Texts with equal sets (a 128-bit fingerprint) are one node, their smallest id;
   exact copies never meet in a bucket.
3. Nodes that share a band are candidates.  A bucket is not expanded into pairs: its
   members are compared with the member that shares the most buckets, which in a
   group of copies is the text they were made from.  Signature bytes rule out pairs
   whose estimate is far below the threshold; the rest is confirmed on full sets.
4. Buckets whose members are not yet one component are then searched for links
   between components.  A member takes part only if enough of its shingles occur in
   another component, and meets only members whose counts allow the threshold; both
   are bounds, so every candidate pair is tried, connected already, or impossible.
5. Components come from alternating large-star and small-star.

With 32 bands of 4 minima a pair at similarity 0.8 shares no band with probability
5e-8; its 128 signature bytes miss the margin with about 1e-5, its 2,048 bits (step 4)
with about 1e-6.

Defined results: null and empty texts and texts without words have an empty set, are
linked with nothing and kept; rows with a null id take no part and are kept; rows that
share an id are one document, linked with all that any of its texts is linked with; ties are
broken by the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, components, mix, shingles, ship, stored, words_of

BANDS, ROWS = 32, 4
PERMS = BANDS * ROWS
_rng = np.random.default_rng(20240601)
#: Multiply-shift hashes of 64 bits: odd factors and offsets.
FACTORS = _rng.integers(0, 1 << 63, PERMS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
OFFSETS = _rng.integers(0, 1 << 63, PERMS, dtype=np.uint64)
STEP = 512
#: Minima of the long signature (one bit each).
LONG = 2048
LONG_FACTORS = _rng.integers(0, 1 << 63, LONG, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
SIGNED = "id bigint, n_shingles bigint, fp binary, bands array<bigint>, sig binary"


def minima(x: np.ndarray) -> np.ndarray:
    """The high 32 bits of the minimum of each hash over a set of 64-bit numbers."""
    low = np.full(PERMS, np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(x), STEP):
        h = FACTORS[:, None] * x[None, s:s + STEP]
        h += OFFSETS[:, None]
        np.minimum(low, h.min(axis=1), out=low)
    return low >> np.uint64(32)


def long_signature(x: np.ndarray) -> np.ndarray:
    """One bit of each of LONG minima, as 64-bit numbers."""
    low = np.full(LONG, np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(x), 64):
        np.minimum(low, (LONG_FACTORS[:, None] * x[None, s:s + 64]).min(axis=1), out=low)
    return np.packbits((mix(low) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def band_hashes(m: np.ndarray) -> np.ndarray:
    """(n, PERMS) minima to (n, BANDS) hashes; the band's number is part of a hash."""
    r = m.reshape(len(m), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), r.shape[:2]).copy()
    for j in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + r[:, :, j])
    return h.view(np.int64)


def _sign(words: int):
    def run(batches):
        import xxhash
        hashes = WordHashes()
        for b in batches:
            ns, fps, sigs = [], [], np.zeros((len(b), PERMS), np.uint64)
            for i, t in enumerate(b["text"]):
                s = shingles(hashes.of(words_of(t)), words)
                ns.append(len(s))
                fps.append(xxhash.xxh3_128_digest(s.tobytes()))
                if len(s):
                    sigs[i] = minima(s)
            low = sigs.astype(np.uint8)
            yield pd.DataFrame({"id": b["id"], "n_shingles": ns, "fp": fps, "bands": list(band_hashes(sigs)),
                                "sig": [x.tobytes() for x in low]})
    return run


def _estimate(least: int):
    def run(batches):
        for b in batches:
            if not len(b):
                continue
            x = np.frombuffer(b"".join(b["sig_a"]), np.uint8).reshape(-1, PERMS)
            y = np.frombuffer(b"".join(b["sig_b"]), np.uint8).reshape(-1, PERMS)
            same = (x == y).sum(axis=1)
            keep = same >= least
            yield pd.DataFrame({"a": b["a"][keep], "b": b["b"][keep], "same": same[keep].astype(np.int32)})
    return run


def _confirm(words: int, percent: int):
    def run(batches):
        hashes = WordHashes()
        held: dict[int, np.ndarray] = {}

        def full(i: int, t) -> np.ndarray:
            if i not in held:
                if len(held) >= 64:
                    held.clear()
                held[i] = shingles(hashes.of(words_of(t)), words)
            return held[i]

        for b in batches:
            keep = []
            for i, j, x, y in zip(b["a"], b["b"], b["text_a"], b["text_b"]):
                p, q = full(i, x), full(j, y)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield b.loc[keep, ["a", "b"]]
    return run


def estimated(pairs: DataFrame, signed: DataFrame, least: int) -> DataFrame:
    """Pairs whose signatures agree in ``least`` places or more, with that number."""
    s = signed.select("id", "sig")
    return (pairs.join(s.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(s.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
            .mapInPandas(_estimate(least), "a bigint, b bigint, same int"))


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    return (pairs.select("a", "b").join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
            .mapInPandas(_confirm(words, percent), "a bigint, b bigint"))


def links(docs: DataFrame, signed: DataFrame, nodes: DataFrame, words: int, percent: int, sure: int) -> DataFrame:
    """Confirmed links (a, b) between nodes; together they connect what all links connect."""
    bands = nodes.select("id", F.explode("bands").alias("bucket"))
    several = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(bands.join(several, "bucket"), "members")
    central = members.groupBy("id").agg(F.sum("n").alias("central"))
    leaders = (members.join(central, "id").groupBy("bucket")
               .agg(F.max(F.struct("central", (-F.col("id")).alias("minus"))).alias("m"))
               .select("bucket", (-F.col("m.minus")).alias("b")))
    star = members.join(leaders, "bucket").where("id <> b").select(F.col("id").alias("a"), "b").distinct()
    near = stored(estimated(star, signed, sure), "near")
    wanted = members.select("id").distinct()
    texts = stored(docs.join(wanted, "id"), "texts")
    found = stored(confirmed(near, texts, words, percent), "links")
    comp = components(found)
    # Links between components that no leader saw: only in buckets of several components.
    held = stored(members.select("bucket", "id").join(comp.withColumnRenamed("node", "id"), "id", "left")
                  .select("bucket", "id", F.coalesce("root", "id").alias("root")), "held")
    mixed = stored(_mixed(held), "mixed")
    able = stored(_able(mixed, texts, words, percent), "able")
    # Only members that can reach the threshold with another component at all.
    mixed = _mixed(mixed.join(able.join(nodes, "id"), "id"))
    x, y = (mixed.select("bucket", *[F.col(c).alias(f"{c}_{side}") for c in ("id", "root", "n", "shared", "bits", "bands")]) for side in "ab")
    common = F.filter(F.zip_with("bands_a", "bands_b", lambda a, b: F.when(a == b, a)), lambda a: a.isNotNull())
    differ = sum((F.bit_count(F.col("bits_a")[i].bitwiseXOR(F.col("bits_b")[i])) for i in range(LONG // 64)), F.lit(0))
    p = (1 + percent / 100) / 2
    cross = x.join(y, "bucket").where(
        (F.col("root_a") < F.col("root_b"))
        & ((100 + percent) * F.least("shared_a", "shared_b") >= percent * (F.col("n_a") + F.col("n_b")))
        & (differ <= int(LONG * (1 - p) + 4.75 * (LONG * p * (1 - p)) ** 0.5))
        & (common[0] == F.col("bucket")))  # a pair of several buckets comes out of the first one
    cross = cross.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
    return found.unionByName(stored(confirmed(cross, texts, words, percent), "links"))


def _mixed(held: DataFrame) -> DataFrame:
    """Rows of ``held`` in buckets whose members are of several components."""
    split = (held.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .where("lo < hi").select("bucket"))
    return held.join(split, "bucket", "left_semi")


def _able(mixed: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(id, n, shared, bits): members whose set could reach the threshold with a member of
    another component.  ``shared`` counts the shingles that also occur in another
    component; no pair across components has a larger intersection.  Edits of a copy
    that nobody shares so rule it out against the whole group, without pairs.  ``bits``
    is a long signature, one bit of each of LONG minima, for the few that are left."""
    def sets(batches):
        hashes = WordHashes()
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "root": b["root"],
                                "s": [shingles(hashes.of(words_of(t)), words).view(np.int64) for t in b["text"]]})

    own = mixed.select("id", "root").distinct()
    rows = stored(own.join(texts, "id").select("id", "root", "text").mapInPandas(sets, "id bigint, root bigint, s array<bigint>")
                  .dropDuplicates(["id"]), "sets")
    each = rows.select("id", "root", F.explode("s").alias("shingle"))
    across = stored(each.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                    .where("lo < hi").select("shingle"), "across")
    shared = each.join(across, "shingle").groupBy("id").agg(F.count(F.lit(1)).alias("shared"))

    def long_signatures(batches):
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "n": b["n"], "shared": b["shared"],
                                "bits": [long_signature(np.asarray(x).view(np.uint64)) for x in b["s"]]})

    left = rows.select("id", "s", F.size("s").cast("long").alias("n")).join(shared, "id")
    return (left.where(100 * F.col("shared") >= percent * F.col("n"))
            .mapInPandas(long_signatures, "id bigint, n bigint, shared bigint, bits array<bigint>"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80, margin: float = 0.15) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id (the smallest id it is
    linked with over any number of links) and kept (it is that one)."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sure = int(PERMS * (percent / 100 - margin))
    signed = stored(src.mapInPandas(_sign(words), SIGNED), "signed")
    # Ids with several texts: each of their texts is a node of its own, by a hash.
    several = stored(signed.where("id is not null").groupBy("id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("id"), "several")
    if several.isEmpty():
        comp = _components(src, signed, words, percent, sure)
    else:
        own = src.join(several, "id").select(F.xxhash64("id", "text").alias("node"), "id", "text")
        keys = stored(own.select("node", "id").distinct(), "keys")
        keyed = own.select(F.col("node").alias("id"), "text").unionByName(src.join(several, "id", "left_anti"))
        again = stored(own.select(F.col("node").alias("id"), "text").mapInPandas(_sign(words), SIGNED)
                       .unionByName(signed.join(several, "id", "left_anti")), "signed")
        same = keys.join(keys.groupBy("id").agg(F.min("node").alias("b")), "id").where("node <> b").select(F.col("node").alias("a"), "b")
        found = _components(keyed, again, words, percent, sure, same)
        # from nodes back to ids, the smallest of which is the component's
        ids = found.join(keys, "node", "left").select("root", F.coalesce("id", "node").alias("node"))
        least = ids.groupBy("root").agg(F.min("node").alias("least"))
        comp = ids.join(least, "root").select("node", F.col("least").alias("root")).distinct()
    return (signed.join(comp.withColumnRenamed("node", "id"), "id", "left")
            .select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("root", "id").alias("component_id"),
                    F.coalesce(F.col("root") == F.col("id"), F.lit(True)).alias("kept")))


def _components(src: DataFrame, signed: DataFrame, words: int, percent: int, sure: int, more: DataFrame | None = None) -> DataFrame:
    """(node, root) of the linked nodes; ``more`` are further links, between nodes that are one document."""
    # Sets that occur more than once, by their smallest id; stored, so that the join
    # below gets exchanges of its own, whose large partitions can be split.
    linked = signed.where("n_shingles > 0 and id is not null")
    copies = stored(linked.groupBy("fp").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").select("fp", "rep"), "copies")
    of = stored(linked.select("id", "fp").join(copies, "fp", "left").select("id", F.coalesce("rep", "id").alias("rep")), "of")
    others = of.where("id <> rep").select("id").distinct()
    nodes = linked.join(others, "id", "left_anti")
    found = links(src.where("id is not null"), linked, nodes.select("id", "bands"), words, percent, sure)
    every = found.unionByName(of.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    return components(every if more is None else every.unionByName(more))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs``, all columns, with one document of each group: the one with the smallest id.
    Of rows that repeat an id with its text one stays."""
    gone = near_duplicates(docs, id_col=id_col, text_col=text_col, **kw).where("not kept").select(F.col("doc_id").alias("_gone"))
    left = docs.join(gone.distinct(), docs[id_col] == F.col("_gone"), "left_anti")
    again = stored(docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).count().where("count > 1").select("_id"), "again")
    if again.isEmpty():
        return left
    once = left.join(again, left[id_col] == F.col("_id"), "left_semi")
    return left.join(again, left[id_col] == F.col("_id"), "left_anti").unionByName(once.dropDuplicates([id_col, text_col]))


SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') as g
  from w, unnest(range(1, greatest(2, len(w) - 2))) as u(i) where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
-- a pair above the threshold shares a shingle among the (n - ceil(0.8 n) + 1) rarest of each
f as (select g, count(*) as c from s group by g),
o as (select s.doc_id, s.g, n.n, row_number() over (partition by s.doc_id order by f.c, s.g) as r
      from s join f using (g) join n using (doc_id) where f.c > 1 or n.n = 1),
r1 as (select doc_id, g, n from o where r <= n - cast(ceil(0.8 * n) as bigint) + 1),
cand as (select distinct a.doc_id as a, b.doc_id as b from r1 a join r1 b using (g)
         where a.doc_id < b.doc_id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
both_ as (select a, b, count(*) as k from cand join s x on x.doc_id = a join s y on y.doc_id = b and y.g = x.g group by a, b),
e as (select a, b from both_ join n p on p.doc_id = a join n q on q.doc_id = b where 100 * k >= 80 * (p.n + q.n - k)),
u as (select a, b from e union all select b, a from e),
c(id, root) as (
  select distinct a, a from u
  union
  select u.b, c.root from c join u on u.a = c.id where c.root < u.b),
m as (select id, min(root) as root from c group by id)
select w.doc_id, coalesce(n.n, 0) as n_shingles, least(coalesce(m.root, w.doc_id), w.doc_id) as component_id,
       least(coalesce(m.root, w.doc_id), w.doc_id) = w.doc_id as kept
from w left join n using (doc_id) left join m on m.id = w.doc_id
"""
