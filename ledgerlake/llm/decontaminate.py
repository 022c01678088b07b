"""Benchmark decontamination: a broadcast set of benchmark word n-grams, scanned
over every document in one narrow pass.

The set of windows is small beside the corpus, but it is measured: it is cut into
slices of at most ``slice_windows`` windows by item, and each slice is broadcast
and scanned by itself; hits of several slices are merged per document.  Nothing
but the slice ever leaves Spark's tasks.

Defined results: a null or empty text has no words, so it has no hit; an empty
benchmark hits nothing; equal texts give equal rows, one per input row; items of
fewer words than a window count whole; items with a null id count as hits
but carry no id.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, mix, ship, stored

#: Bytes that separate words once A-Z are in lower case.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
TO_SPACE = bytes.maketrans(SEPARATORS, b" " * len(SEPARATORS))
STEP = np.uint64(0x9E3779B97F4A7C15)


def benchmark_words(text) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z in lower case."""
    return as_bytes(text).lower().translate(TO_SPACE).split()


class WindowSet:
    """Windows of benchmark items with the items that hold each."""

    def __init__(self, items: list[tuple], words: int):
        self.vocabulary: dict[bytes, int] = {}
        exact: dict[tuple, set] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in benchmark_words(text)]
            n = min(words, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                exact.setdefault(tuple(ids[i:i + n]), set()).add(item)
        self.exact = exact
        self.lengths = sorted({len(w) for w in exact})
        self.hashes = {n: np.sort(self._hash(np.array([w for w in exact if len(w) == n], np.uint64))) for n in self.lengths}

    @staticmethod
    def _hash(windows: np.ndarray) -> np.ndarray:
        h = np.zeros(len(windows), np.uint64)
        for j in range(windows.shape[1]):
            h = h * STEP + windows[:, j]
        return mix(h)

    def scan(self, text) -> tuple[int, np.ndarray, set]:
        """Number of words, the mask of hit words, the items found (None among them
        if an item without id was hit)."""
        words = benchmark_words(text)
        n = len(words)
        hit = np.zeros(n, bool)
        items: set = set()
        if not n or not self.vocabulary:
            return n, hit, items
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, n).astype(np.uint64)
        known = np.r_[0, np.cumsum(ids > 0)]
        for m in self.lengths:
            if m > n:
                continue
            at = np.flatnonzero(known[m:] - known[:-m] == m)
            if not len(at):
                continue
            windows = ids[at[:, None] + np.arange(m)]
            h, own = self._hash(windows), self.hashes[m]
            p = np.minimum(np.searchsorted(own, h), len(own) - 1)
            for k in np.flatnonzero(own[p] == h):
                found = self.exact.get(tuple(windows[k].tolist()))
                if found:
                    hit[at[k]:at[k] + m] = True
                    items |= found
        return n, hit, items


def _slices(benchmark: DataFrame, item_col: str, text_col: str, slice_bytes: int) -> list[Callable[[], list[tuple]]]:
    """The benchmark's rows as slices of bounded size, each read when it is called."""
    ship(benchmark.sparkSession)
    src = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // slice_bytes))
    if count == 1:
        return [lambda: [tuple(r) for r in src.collect()]]
    part = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    return [lambda i=i: [tuple(r) for r in src.where(part == i).collect()] for i in range(count)]


SPANS = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType()))])


def _spans(hit: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
    return np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", words: int = 10,
                  slice_bytes: int = 16 << 20) -> DataFrame:
    """One row per document row: ``doc_id``, ``n_words``, hit word spans ``starts``
    (inclusive) and ``ends`` (exclusive), and the ids of ``items`` as sorted strings."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", src.schema["doc_id"].dataType), *SPANS.fields[1:]])

    def scanned(rows: list[tuple]) -> DataFrame:
        given = spark.sparkContext.broadcast(WindowSet(rows, words))

        def run(batches):
            windows = given.value
            for b in batches:
                out = []
                for t in b["text"]:
                    n, hit, items = windows.scan(t)
                    s, e = _spans(hit) if items else ([], [])
                    out.append((n, s, e, sorted({str(i) for i in items if i is not None})))
                yield pd.DataFrame({"doc_id": b["doc_id"], "n_words": [o[0] for o in out], "starts": [o[1] for o in out],
                                    "ends": [o[2] for o in out], "items": [o[3] for o in out]})
        return run

    slices = _slices(benchmark, item_col, item_text_col, slice_bytes)
    if len(slices) == 1:
        return src.mapInPandas(scanned(slices[0]()), schema)
    # Several slices: number the rows once, scan each slice, merge hits per row.
    numbered = stored(src.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
    found = None
    for rows in slices:
        part = (numbered.select(F.col("row").alias("doc_id"), "text")
                .mapInPandas(scanned(rows()), T.StructType([T.StructField("doc_id", T.LongType()), *SPANS.fields[1:]]))
                .where(F.size("starts") > 0))
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy("doc_id").agg(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))).alias("spans"),
                                         F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    start = F.array_sort("spans")
    joined = F.aggregate(
        start, F.expr("cast(array() as array<struct<starts:bigint,ends:bigint>>)"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, F.greatest(F.lit(1), F.size(acc)))["ends"] >= x["starts"]),
                              F.concat(F.slice(acc, 1, F.greatest(F.lit(0), F.size(acc) - 1)),
                                       F.array(F.struct(F.element_at(acc, F.greatest(F.lit(1), F.size(acc)))["starts"].alias("starts"),
                                                        F.greatest(F.element_at(acc, F.greatest(F.lit(1), F.size(acc)))["ends"], x["ends"]).alias("ends")))))
        .otherwise(F.concat(acc, F.array(x))))
    merged = merged.select(F.col("doc_id").alias("row"), joined.alias("spans"), "items")
    none = F.array().cast("array<bigint>")
    words_n = F.size(F.regexp_extract_all(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                                          F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"))).cast("long")
    return numbered.join(merged, "row", "left").select(
        "doc_id", F.coalesce(F.when(F.col("text").isNotNull(), words_n), F.lit(0).cast("long")).alias("n_words"),
        F.coalesce(F.col("spans.starts"), none).alias("starts"), F.coalesce(F.col("spans.ends"), none).alias("ends"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def digest(found: DataFrame) -> DataFrame:
    """The counts and the digest of the items of ``contamination``."""
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words",
        F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("starts") > 0).alias("contaminated"))


def _clean(given):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not given.value.scan(t)[2] for t in texts], dtype=bool)
    return clean


def _cut(given):
    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([cut_text(t, given.value) for t in texts], dtype=object)
    return cut


def remove_documents(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                     item_text_col: str = "text", words: int = 10, slice_bytes: int = 16 << 20) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark window.  One narrow
    pass per slice; only the text and a verdict cross into Python."""
    spark = docs.sparkSession
    for rows in _slices(benchmark, item_col, item_text_col, slice_bytes):
        given = spark.sparkContext.broadcast(WindowSet(rows(), words))
        docs = docs.where(_clean(given)(F.col(text_col)))
    return docs


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", words: int = 10, slice_bytes: int = 16 << 20) -> DataFrame:
    """The rows of ``docs`` with hit words cut out of the text (a run of hit words and
    what stands between them becomes one space)."""
    spark = docs.sparkSession
    for rows in _slices(benchmark, item_col, item_text_col, slice_bytes):
        given = spark.sparkContext.broadcast(WindowSet(rows(), words))
        docs = docs.withColumn(text_col, _cut(given)(F.col(text_col)))
    return docs


def cut_text(text, windows: WindowSet):
    if text is None:
        return None
    _, hit, items = windows.scan(text)
    if not items:
        return text
    raw = as_bytes(text)
    spaced = np.frombuffer(raw.lower().translate(TO_SPACE), np.uint8)
    inside = ~np.isin(spaced, np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))
    edge = np.diff(np.r_[0, inside.astype(np.int8), 0])
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, last = [], 0
    for s, e in zip(*_spans(hit)):
        out.append(raw[last:begin[s]])
        last = end[e - 1]
    out.append(raw[last:])
    return b" ".join(out).decode("utf-8", "replace")


SQL = r"""
with doc as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
item as (
  select item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
win as (
  select distinct item_id, least(10, len(w)) as n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as g
  from item, unnest(range(1, greatest(2, len(w) - 8))) as u(i) where len(w) > 0),
len_ as (select distinct n from win),
dwin as (
  select r, i, n, array_to_string(w[i:i + n - 1], ' ') as g
  from doc, len_, unnest(range(1, len(w) - n + 2)) as u(i) where len(w) >= n),
hit as (select distinct r, i, n from dwin semi join win using (n, g)),
pos as (select distinct r, p from hit, unnest(range(i, i + n)) as u(p)),
cnt as (select r, count(*) as n_hit from pos group by r),
its as (select r, list_sort(list(distinct cast(item_id as varchar))) as items from dwin join win using (n, g) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(len(items), 0)::bigint as n_items, sha256(coalesce(array_to_string(items, ','), '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from doc left join cnt using (r) left join its using (r)
"""
