"""Exact top-k by inner product over an impact-ordered, score-at-a-time index.

Index: vectors are cut into blocks; the postings of a block (row, dimension,
impact) are put into segments by descending quantised impact, one segment per
power of two of ``|impact|``, with the norm of what is left of each row below each
segment.  A block is one row of a table.

Search: queries are packed into groups.  A task takes one block and one group and
reads the block's segments from the largest impacts down, adding a segment's
contributions to the scores of all queries at once.  After each segment the rest
of a row's score is bounded by Cauchy-Schwarz: at most the norm of its unread
impacts times the norm of the query.  A row whose score plus bound is under the
k-th best score minus bound can't be a member; reading stops only when that proof
leaves few possible members (or nothing unread).  Possible members are then
scored exactly from their whole vectors.  Blocks hand on k rows per query and a
window with a group limit takes the best k of all.

Nothing is dropped: every row is indexed, no bucket or candidate is capped.
Blocks and query groups meet in a keyed join (each block is sent to each group of
queries), so neither side is broadcast.

Defined results: vectors that are null or hold null or non-finite components take
no part, neither do rows with a null id; vectors of different lengths are compared as
if padded with zeros; ties go to the smaller id; a repeated id is a candidate per
row, but never for a query of its own id; fewer candidates than k give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship

#: Whole numbers up to here are exact in double arithmetic.
EXACT = float(1 << 53)
HITS = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
                     T.StructField("score", T.LongType())])
PACK = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("dims", T.IntegerType()),
                     T.StructField("values", T.BinaryType())])


def quantise(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, v): whole-number vectors floor(scale * x), without rows that take no part."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    return (df.where(F.col(id_col).isNotNull() & x.isNotNull() & ~bad)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long")).alias("v")))


def _pack(size: int):
    """Packs of at most ``size`` vectors as binary matrices."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list = []
        rows: list = []

        def row() -> pd.DataFrame:
            dims = max(map(len, rows))
            m = np.zeros((len(rows), dims), np.int64)
            for i, v in enumerate(rows):
                m[i, :len(v)] = v
            return pd.DataFrame({"ids": [np.array(ids, np.int64).tobytes()], "dims": [dims], "values": [m.tobytes()]})

        for b in batches:
            for i, v in zip(b["id"], b["v"]):
                ids.append(i)
                rows.append(v)
                if len(rows) == size:
                    yield row()
                    ids, rows = [], []
        if rows:
            yield row()
    return run


class Block:
    """Impact-ordered segments of one block of vectors."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        size = np.abs(self.values)
        level = np.zeros(size.shape, np.int8)
        level[size > 0] = np.floor(np.log2(size[size > 0])).astype(np.int8) + 1
        self.segments = []
        left = (self.values.astype(np.float64) ** 2)
        for q in sorted(set(np.unique(level)) - {0}, reverse=True):
            row, dim = np.nonzero(level == q)
            left[row, dim] = 0.0
            # an upper bound: rounding up keeps the proof valid
            rest = np.sqrt(left.sum(axis=1)) * (1 + 1e-9)
            self.segments.append((row, dim, self.values[row, dim].astype(np.float64), rest))

    def search(self, queries: np.ndarray, query_ids: np.ndarray, k: int, enough: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, id, score) of the k best rows of this block for each query."""
        n, dims = self.values.shape
        q = np.zeros((len(queries), dims), np.int64)
        shared = min(dims, queries.shape[1])
        q[:, :shared] = queries[:, :shared]
        big = float(np.abs(self.values).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(dims, 1) >= EXACT
        qf = q.astype(np.float64).T.copy()
        norm = np.sqrt((qf ** 2).sum(axis=0)) * (1 + 1e-9)
        keep = min(k + int(np.max(np.unique(self.ids, return_counts=True)[1])), n)
        score = np.zeros((n, len(q)))
        possible = np.ones((n, len(q)), bool)
        for row, dim, impact, rest in self.segments if n > keep and not big else []:
            part = np.zeros((n, dims))
            part[row, dim] = impact
            score += part @ qf
            bound = rest[:, None] * norm[None, :] + 1e-6
            least = np.partition(score - bound, n - keep, axis=0)[n - keep]
            possible = score + bound >= least[None, :]
            if possible.sum() <= enough * len(q):
                break
        at, of = np.nonzero(possible.T)[::-1]
        own = self.ids[at] == query_ids[of]
        at, of = at[~own], of[~own]
        exact = np.empty(len(at), np.int64)
        for s in range(0, len(at), 1 << 16):
            a, o = at[s:s + (1 << 16)], of[s:s + (1 << 16)]
            exact[s:s + (1 << 16)] = np.einsum("ij,ij->i", self.values[a], q[o])
        order = np.lexsort((self.ids[at], -exact, of))
        at, of, exact = at[order], of[order], exact[order]
        first = np.searchsorted(of, np.arange(len(q)))
        best = np.arange(len(of)) - first[of] < k if len(of) else np.zeros(0, bool)
        return of[best], self.ids[at[best]], exact[best]


def _search(k: int, step: int, enough: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, block = None, None
        for b in batches:
            for r in b.itertuples(index=False):
                if held != r.ids:
                    held = r.ids
                    block = Block(np.frombuffer(r.ids, np.int64), np.frombuffer(r.values, np.int64).reshape(len(r.ids) // 8, r.dims))
                ids = np.frombuffer(r.q_ids, np.int64)
                queries = np.frombuffer(r.q_values, np.int64).reshape(len(ids), r.q_dims)
                for s in range(0, len(ids), step):
                    of, found, score = block.search(queries[s:s + step], ids[s:s + step], k, enough)
                    yield pd.DataFrame({"query_id": ids[s:s + step][of], "vec_id": found, "score": score})
    return run


def top_k(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
          scale: float = 64.0, block_rows: int = 1 << 13, group_rows: int = 1 << 12, step: int = 128,
          enough: int = 200) -> DataFrame:
    """The k best rows of ``vectors`` for each row of ``queries``: query_id, rank,
    vec_id, score.  ``enough`` is how many possible members per query end the reading
    of segments; it changes time only, never results."""
    ship(vectors.sparkSession)
    index = quantise(vectors, id_col, vector_col, scale).mapInPandas(_pack(block_rows), PACK)
    rows = queries.count()
    groups = max(1, -(-rows // group_rows))
    asked = quantise(queries, id_col, vector_col, scale)
    # Queries are dealt by a hash of their id, so a group has about group_rows rows.
    packs = (asked.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")).repartition(groups, "grp")
             .groupBy("grp").applyInPandas(_pack_group, T.StructType([T.StructField("grp", T.IntegerType()),
                                                                      T.StructField("q_ids", T.BinaryType()),
                                                                      T.StructField("q_dims", T.IntegerType()),
                                                                      T.StructField("q_values", T.BinaryType())])))
    # A block goes to each group: (group, salt) spreads one group's blocks over tasks.
    salts = 16
    blocks = (index.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
              .withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(salts)).cast("int")))
    packs = packs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    local = (blocks.join(packs, ["grp", "salt"]).select("ids", "dims", "values", "q_ids", "q_dims", "q_values")
             .mapInPandas(_search(k, step, enough), HITS))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _pack_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    dims = max(map(len, pdf["v"]))
    m = np.zeros((len(pdf), dims), np.int64)
    for i, v in enumerate(pdf["v"]):
        m[i, :len(v)] = v
    return pd.DataFrame({"grp": [key[0]], "q_ids": [pdf["id"].to_numpy(np.int64).tobytes()], "q_dims": [dims],
                         "q_values": [m.tobytes()]})


SQL = """
with v as (
  select vec_id, [cast(floor(64 * cast(x as double)) as bigint) for x in embedding] as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
p as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum([q.e[i] * c.e[i] for i in range(1, len(q.e) + 1)]) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20
"""
