"""Spelling variants: words of a corpus one edit apart, each pointing to its most
frequent neighbour.

1. *Vocabulary.*  Runs of letters of whole texts, lower-cased, counted per task and summed
   in Spark; words of at least ``least_length`` characters and ``least_count`` occurrences stay.
2. *Filters.*  A word's hash is a polynomial over its characters, so the hash of an edit
   is one addition away.  Every word sets a few bits in one 64-bit block of the filter of
   its length (a blocked Bloom filter).  A length with many words has several shards, by
   hash; a shard holds ``shard_words`` words at most on average.  Filters are made in
   Spark, in pieces of ``PIECE`` blocks.
3. *Probes.*  Shards are broadcast in slices of at most ``slice_bytes``, whatever the
   vocabulary's size.  Per slice the words of the slice's lengths (and one more) generate their
   edits: each deletion, and each replacement by a greater character of the vocabulary's
   alphabet.  Every pair of neighbours is one of these for exactly one of its two words, so
   insertions and smaller characters need no probe.
4. *Join.*  Only positives are shuffled: to an exact join with the vocabulary, which
   removes false positives.  Each pair counts for both its words.
5. *Roots.*  Forms are followed by pointer doubling; the counts along a chain grow at least
   ``ratio``-fold, so few rounds are needed.

Defined results: a null or empty text has no words; a null id is written as nothing;
repeated rows count each; ties between neighbours go to the smaller word in code-point
order; an empty table gives no rows.  A text may be as long as a row can be.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, mix, ship, stored

U64 = np.uint64
#: Every 199th (document, word) loses a character.
DROP = 199
#: Random values of the 256 characters up to U+00FF, and the odd base of the polynomial.
VALUES = np.random.default_rng(20240707).integers(0, 1 << 63, 256, dtype=U64) << U64(1) | U64(1)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Bits a word sets in its block, and bits of filter per word.
BITS_SET, BITS_PER_WORD = 6, 24
PIECE = 4096
#: Letters in Latin-1 in their place, A-Z lower-cased; every other byte is a space.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text) -> list[bytes]:
    """Maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z in lower case, as Latin-1: a
    character beyond U+00FF becomes ``?``, which is no letter."""
    if text is None or text != text:
        return []
    if not isinstance(text, str):
        text = bytes(text).decode("utf-8", "replace")
    return text.encode("latin-1", "replace").translate(LETTERS).split()


def _count(least_length: int, flush: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, int] = {}
        utf8: dict[bytes, bytes] = {}

        def out() -> pd.DataFrame:
            made = pd.DataFrame({"word": [w.decode("latin-1") for w in seen], "n": list(seen.values())})
            seen.clear()
            utf8.clear()
            return made
        for b in batches:
            for doc, text in zip(b["id"], b["text"]):
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for w, n in Counter(w for w in runs(text) if len(w) >= least_length).items():
                    u = utf8.get(w)
                    if u is None:
                        u = utf8[w] = w.decode("latin-1").encode()
                    h = zlib.crc32(u, start)
                    if h % DROP == 0:
                        w = w[:h % len(w)] + w[h % len(w) + 1:]
                        if len(w) < least_length:
                            continue
                    seen[w] = seen.get(w, 0) + n
                if len(seen) + len(utf8) >= flush:
                    yield out()
        if seen:
            yield out()
    return count


def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6,
               least_count: int = 5, flush: int = 1 << 20) -> DataFrame:
    """(word, n): words with their occurrences.  A task holds at most about ``flush``
    words at a time and hands on what it counted so far."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInPandas(_count(least_length, flush), "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def letters(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)


def powers(length: int) -> np.ndarray:
    """BASE ** (i + 1) mod 2**64."""
    return np.array([pow(BASE, i + 1, 1 << 64) for i in range(length)], U64)


def hashes(chars: np.ndarray) -> np.ndarray:
    """The polynomial of each row."""
    return (VALUES[chars] * powers(chars.shape[1])).sum(axis=1, dtype=U64)


def address(h: np.ndarray, shards: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, block, mask) of polynomials: three independent parts of the mixed hash."""
    m = mix(h)
    block = ((m >> U64(32)) * U64(blocks)) >> U64(32)
    bits = mix(m ^ U64(BASE))
    shard = (bits >> U64(40)) % U64(shards)
    mask = np.zeros(len(h), U64)
    for i in range(BITS_SET):
        mask |= U64(1) << ((bits >> U64(6 * i)) & U64(63))
    return shard.astype(np.int64), block.astype(np.int64), mask


#: length -> (shards, blocks in each)
Layout = dict[int, tuple[int, int]]


def layout(counts: dict[int, int], shard_words: int) -> Layout:
    out = {}
    for length, n in counts.items():
        shards = max(1, -(-n // shard_words))
        out[length] = shards, max(1, -(-n * BITS_PER_WORD // (64 * shards)))
    return out


def _by_length(words) -> dict[int, list[bytes]]:
    out: dict[int, list[bytes]] = {}
    for w in words:
        w = w.encode("latin-1")
        out.setdefault(len(w), []).append(w)
    return out


def _place(shape: Layout):
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for length, words in _by_length(b["word"]).items():
                shard, block, mask = address(hashes(letters(words, length)), *shape[length])
                yield pd.DataFrame({"length": length, "shard": shard, "piece": block // PIECE, "block": block, "mask": mask.view(np.int64)})
    return place


def _fill(shape: Layout):
    def fill(key, rows):
        length, shard, piece = key
        bits = np.zeros(min(PIECE, shape[length][1] - piece * PIECE), U64)
        np.bitwise_or.at(bits, rows["block"].to_numpy() - piece * PIECE, rows["mask"].to_numpy().view(U64))
        return pd.DataFrame({"length": [length], "shard": [shard], "piece": [piece], "bits": [bits.tobytes()]})
    return fill


def filters(words: DataFrame, shape: Layout) -> DataFrame:
    """(length, shard, piece, bits): all filters in pieces of at most PIECE blocks."""
    placed = words.select("word").mapInPandas(_place(shape), "length int, shard bigint, piece bigint, block bigint, mask bigint")
    return placed.groupBy("length", "shard", "piece").applyInPandas(_fill(shape), "length int, shard bigint, piece bigint, bits binary")


def slices(shape: Layout, slice_bytes: int) -> list[list[tuple[int, int]]]:
    """The shards (length, shard) in groups of at most ``slice_bytes`` (one shard at least)."""
    out: list[list[tuple[int, int]]] = []
    room = 0
    for length, (shards, blocks) in sorted(shape.items()):
        for s in range(shards):
            if not out or room < 8 * blocks:
                out.append([])
                room = slice_bytes
            out[-1].append((length, s))
            room -= 8 * blocks
    return out


def edits(chars: np.ndarray, alphabet: np.ndarray, deletions: bool) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray | None]]:
    """(hashes, rows, position, characters) of the edits of words of one length: deletions
    (of a run of equal characters only the last), or replacements by greater characters."""
    n, length = chars.shape
    power = powers(length)
    terms = VALUES[chars] * power
    whole = terms.sum(axis=1, dtype=U64)
    if deletions:
        after = whole.copy()
        before = np.zeros(n, U64)
        for i in range(length):
            after -= terms[:, i]
            rows = np.flatnonzero(chars[:, i] != chars[:, i + 1]) if i + 1 < length else np.arange(n)
            yield (before + after * U64(BASE_INVERSE))[rows], rows, i, None
            before += terms[:, i]
        return
    for i in range(length):
        rows, which = np.nonzero(alphabet[None, :] > chars[:, i:i + 1])
        put = alphabet[which]
        yield whole[rows] - terms[rows, i] + VALUES[put] * power[i], rows, i, put


def _probe(given, shape: Layout, alphabet: bytes, step: int):
    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        have: dict[int, dict[int, np.ndarray]] = {}
        for length, shard, bits in given.value:
            have.setdefault(length, {})[shard] = np.frombuffer(bits, U64)
        signs = np.frombuffer(alphabet, np.uint8)
        for b in batches:
            count = dict(zip(b["word"], b["n"]))
            for length, words in _by_length(b["word"]).items():
                for to, deletions in ((length, False), (length - 1, True)):
                    if to not in have:
                        continue
                    for s in range(0, len(words), step):
                        part = words[s:s + step]
                        chars = letters(part, length)
                        found: dict[str, list] = {"word": [], "n": [], "near": []}
                        for h, rows, i, put in edits(chars, signs, deletions):
                            shard, block, mask = address(h, *shape[to])
                            hit = np.zeros(len(h), bool)
                            for k, bits in have[to].items():
                                own = np.flatnonzero(shard == k)
                                hit[own] = bits[block[own]] & mask[own] == mask[own]
                            for j in np.flatnonzero(hit):
                                w = part[rows[j]]
                                text = w.decode("latin-1")
                                found["word"].append(text)
                                found["n"].append(count[text])
                                found["near"].append(text[:i] + ("" if put is None else chr(put[j])) + text[i + 1:])
                        if found["word"]:
                            yield pd.DataFrame(found)
    return probe


def neighbours(words: DataFrame, *, shard_words: int = 1 << 21, slice_bytes: int = 16 << 20, step: int = 2048) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words of ``words`` (a stored
    table: word, n) one edit apart."""
    spark = words.sparkSession
    counts = {r["length"]: r["count"] for r in words.groupBy(F.length("word").alias("length")).count().collect()}
    shape = layout(counts, shard_words)
    pieces = stored(filters(words, shape), "bloom")
    alphabet = bytes(sorted({ord(r[0]) for r in words.select(F.explode(F.split("word", "")).alias("c")).distinct().collect() if r[0]}))
    found = None
    for part in slices(shape, slice_bytes):
        wanted = F.lit(False)
        for length in sorted({x for x, _ in part}):
            own = [s for x, s in part if x == length]
            wanted |= (F.col("length") == length) & F.col("shard").between(min(own), max(own))
        parts: dict[tuple[int, int], list[bytes]] = {}
        for r in pieces.where(wanted).orderBy("length", "shard", "piece").collect():
            parts.setdefault((r["length"], r["shard"]), []).append((r["piece"], r["bits"]))
        whole = []
        for (length, shard), got in parts.items():
            bits = np.zeros(shape[length][1], U64)
            for piece, raw in got:
                bits[piece * PIECE:piece * PIECE + len(raw) // 8] = np.frombuffer(raw, U64)
            whole.append((length, shard, bits.tobytes()))
        given = spark.sparkContext.broadcast(whole)
        lengths = sorted({x for x, _ in part} | {x + 1 for x, _ in part})
        hits = stored(words.where(F.length("word").isin(lengths)).mapInPandas(
            _probe(given, shape, alphabet, step), "word string, n bigint, near string"), "positives")
        given.destroy()  # one slice is broadcast at a time
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = spark.createDataFrame([], "word string, n bigint, near string")
    exact = found.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")
    both = F.explode(F.array(F.struct("word", "n", "near", "near_n"),
                             F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return exact.select(both.alias("p")).select("p.*")


def roots(links: DataFrame) -> DataFrame:
    """(word, form) to (word, root): forms followed to the last word."""
    at = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        more = F.col("b.root").isNotNull()
        new = stored(at.alias("a").join(at.alias("b"), F.col("a.root") == F.col("b.word"), "left").select(
            F.col("a.word").alias("word"), F.coalesce("b.root", "a.root").alias("root"), more.alias("more")), "roots")
        drop_stored(at)
        if new.where("more").isEmpty():
            return new.drop("more")
        at = new.drop("more")


def variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5,
             ratio: int = 5, shard_words: int = 1 << 21, slice_bytes: int = 16 << 20, flush: int = 1 << 20) -> DataFrame:
    """One row per word: word, n, form, form_n, root, n_near."""
    words = stored(vocabulary(docs, id_col=id_col, text_col=text_col, least_length=least_length, least_count=least_count, flush=flush), "words")
    pairs = neighbours(words, shard_words=shard_words, slice_bytes=slice_bytes)
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                     F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("b"))
    is_form = -F.col("b.minus") >= ratio * F.col("n")
    near = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("b.near")).alias("form"),
        F.when(is_form, -F.col("b.minus")).alias("form_n")), "forms")
    last = roots(near.where("form is not null").select("word", "form"))
    return near.join(last, "word", "left").select("word", "n", "form", "form_n", F.coalesce("root", "word").alias("root"), "n_near")


SQL = """
with recursive tab as (
  select list(crc order by i) as t from (
    select i, list_reduce([cast(i as bigint)] || [cast(0 as bigint) for k in range(8)],
                          lambda a, x: case when a & 1 = 1 then xor(a >> 1, cast(3988292384 as bigint)) else a >> 1 end) as crc
    from range(256) as r(i))),
run as (
  select id, w, count(*) as c, lower(hex(encode(id || ':' || w))) as h from (
    select coalesce(cast(doc_id as varchar), '') as id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[a-z\\x{00C0}-\\x{00FF}]+')) as w from documents)
  where length(w) >= 6 group by id, w),
hashed as (
  select w, c, xor(list_reduce([cast(4294967295 as bigint)]
                               || [cast('0x' || substr(h, cast(2 * i + 1 as bigint), 2) as bigint) for i in range(len(h) // 2)],
                               lambda a, x: xor(a >> 8, tab.t[xor(a & 255, x) + 1])), cast(4294967295 as bigint)) as crc
  from run, tab),
v as materialized (
  select word, cast(sum(c) as bigint) as n from (
    select case when crc % 199 = 0 then substr(w, 1, crc % length(w)) || substr(w, crc % length(w) + 2) else w end as word, c from hashed)
  where length(word) >= 6 group by word having sum(c) >= 5),
cut as materialized (
  select word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest from (select word, n, unnest(range(length(word))) as i from v)),
pair as (
  select a.word, a.n, b.word as near, b.n as near_n from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select c.word, c.n, v.word, v.n from cut c join v on v.word = c.rest
  union select v.word, v.n, c.word, c.n from cut c join v on v.word = c.rest),
best as (
  select word, count(*) as n_near, max(near_n) as most from pair group by word),
formed as materialized (
  select v.word, v.n, coalesce(n_near, 0) as n_near, case when most >= 5 * v.n then most end as form_n,
         case when most >= 5 * v.n then (select min(near) from pair p where p.word = v.word and p.near_n = best.most) end as form
  from v left join best on best.word = v.word),
chain as (
  select word, form as root, 1 as depth from formed where form is not null
  union all select chain.word, f.form, depth + 1 from chain join formed f on f.word = chain.root where f.form is not null),
final as (select word, arg_max(root, depth) as root from chain group by word)
select f.word, f.form, coalesce(final.root, f.word) as root, f.n, f.n_near, f.form_n
from formed f left join final on final.word = f.word
"""
