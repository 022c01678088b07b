"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A document descends region, rack and shard.  At each level every child draws
``-ln(u) / weight`` with u a hash of (key, child) in (0, 1); the smallest draw
wins, so a child is chosen in proportion to its weight and a draw depends on
nothing but the key and the child.  A weight that changes moves rows only into or
out of the subtrees whose weights change.  A grown tree gets the new shard in a
region of its own, so the only weight that changes above existing shards is none:
rows move into the new shard and nowhere else.

Slots number the rows of a shard from 0 without gaps.  No shard is gathered in one
task: rows are numbered within (shard, part), with parts of bounded size, and
parts are offset by their counts, a table of one row per part.

Defined results: a null text has size 8 and crc32 0 like an empty one; a null key
is drawn as the empty string; repeated rows go to the same shard and get a slot
each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: (region, rack, shard, weight)
Leaf = tuple[int, int, int, float]


def tree(shards: int, per_rack: int = 2, racks: int = 4, weight: float = 1.0) -> list[Leaf]:
    """Shards 0..n-1 with equal weights, filled rack by rack and region by region."""
    per_region = per_rack * racks
    return [(s // per_region, s // per_rack, s, weight) for s in range(shards)]


def grow(leaves: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a region and a rack of its own."""
    return [*leaves, (max(x[0] for x in leaves) + 1, max(x[1] for x in leaves) + 1, max(x[2] for x in leaves) + 1, weight)]


def hashed(text: Column) -> Column:
    """A number of 52 bits."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def draw(key: Column, level: str, child: Column, weight: Column) -> Column:
    """The draw of one child: 52 bits of a hash, as an exponential of its weight."""
    bits = hashed(F.concat(key, F.lit(f"/{level}/"), child.cast("string"))).cast("double")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52))) / weight


def _children(leaves: Sequence[Leaf], depth: int) -> Column:
    """Map of a node to its children at ``depth`` with their weights (the sums of
    their leaves); children of no weight are left out."""
    weights: dict[int, dict[int, float]] = {}
    for x in leaves:
        if x[3] > 0:
            own = weights.setdefault(x[depth - 1] if depth else 0, {})
            own[x[depth]] = own.get(x[depth], 0.0) + x[3]
    entries = []
    for node, children in sorted(weights.items()):
        entries += [F.lit(node), F.array(*[F.struct(F.lit(c).alias("c"), F.lit(float(w)).alias("w"))
                                           for c, w in sorted(children.items())])]
    return F.create_map(*entries)


def _draws(key: Column, level: str, children: Column) -> Column:
    return F.transform(children, lambda x: F.struct(draw(key, level, x["c"], x["w"]).alias("d"), x["c"].alias("c")))


def descend(key: Column, leaves: Sequence[Leaf]) -> Column:
    """The leaf a key comes to: at each level the child with the smallest draw, ties
    to the smaller child."""
    node = F.lit(0)
    for depth, level in enumerate(("region", "rack", "shard")):
        node = F.array_min(_draws(key, level, _children(leaves, depth)[node]))["c"]
    return node


def assign(df: DataFrame, key_col: str, leaves: Sequence[Leaf], out: str = "shard") -> DataFrame:
    """``df`` with the shard of every row by the tree."""
    key = F.coalesce(F.col(key_col).cast("string"), F.lit(""))
    return df.withColumn(out, descend(key, leaves).cast("int"))


def slots(df: DataFrame, shard_col: str, order: Sequence[str], rows: int, part_rows: int = 1 << 16) -> DataFrame:
    """``df`` with ``slot``, gapless from 0 in each shard: by part (a hash of the
    first column of ``order``), then by ``order``.  Parts hold about ``part_rows``."""
    parts = max(1, -(-rows // part_rows))
    key = F.coalesce(F.col(order[0]).cast("string"), F.lit(""))
    df = df.withColumn("_part", F.pmod(hashed(F.concat(key, F.lit("/slot"))), F.lit(parts)).cast("int"))
    count = df.groupBy(shard_col, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard_col).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = count.select(F.col(shard_col).alias("_s"), F.col("_part").alias("_p"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy(shard_col, "_part").orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(within))
            .join(offset, (F.col(shard_col) == F.col("_s")) & (F.col("_part") == F.col("_p")))
            .withColumn("slot", F.col("_off") + F.col("_rn") - 1).drop("_part", "_rn", "_s", "_p", "_off", "_n"))


def shard_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = 24) -> DataFrame:
    """Placement of every document row, and its place after one more shard."""
    leaves = tree(shards)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    base = assign(assign(base, "doc_id", leaves), "doc_id", grow(leaves), "grown_shard")
    rows = docs.count()
    return slots(base, "shard", ["doc_id", "text_crc32", "size"], rows).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


SQL = """
with tab as (
  select list(crc order by i) as t from (
    select i, list_reduce([cast(i as bigint)] || [cast(0 as bigint) for k in range(8)],
                          lambda a, x: case when a & 1 = 1 then xor(a >> 1, cast(3988292384 as bigint)) else a >> 1 end) as crc
    from range(256) as r(i))),
d as (
  select doc_id, coalesce(cast(doc_id as varchar), '') as k, lower(hex(encode(coalesce(text, '')))) as h from documents),
c as (
  select doc_id, k, cast(len(h) // 2 + 8 as bigint) as size,
         xor(list_reduce([cast(4294967295 as bigint)]
                         || [cast('0x' || substr(h, cast(2 * i + 1 as bigint), 2) as bigint) for i in range(len(h) // 2)],
                         lambda a, x: xor(a >> 8, tab.t[xor(a & 255, x) + 1])), cast(4294967295 as bigint)) as text_crc32
  from d, tab),
n as (
  select 'region' as level, g as node, 0 as parent, case when g < 3 then 8.0 else 1.0 end as w from range(4) as r(g)
  union all select 'rack', g, g // 4, case when g < 12 then 2.0 else 1.0 end from range(13) as r(g)
  union all select 'shard', g, g // 2, 1.0 from range(25) as r(g)),
w as (
  select k, level, node, parent,
         -ln((cast(cast('0x' || substr(md5(k || '/' || level || '/' || node), 1, 13) as bigint) as double) + 0.5)
             / 4503599627370496.0) / w as draw
  from (select distinct k from c), n),
r24 as (select k, arg_min(node, draw) as region from w where level = 'region' and node < 3 group by k),
r25 as (select k, arg_min(node, draw) as region from w where level = 'region' group by k),
k24 as (select w.k, arg_min(node, draw) as rack from w join r24 on w.k = r24.k and level = 'rack' and parent = region group by w.k),
k25 as (select w.k, arg_min(node, draw) as rack from w join r25 on w.k = r25.k and level = 'rack' and parent = region group by w.k),
s24 as (select w.k, arg_min(node, draw) as shard from w join k24 on w.k = k24.k and level = 'shard' and parent = rack group by w.k),
s25 as (select w.k, arg_min(node, draw) as shard from w join k25 on w.k = k25.k and level = 'shard' and parent = rack group by w.k)
select doc_id, size, text_crc32, 'key' as law, cast(s24.shard as integer) as shard,
       row_number() over (partition by s24.shard order by
           cast('0x' || substr(md5(c.k || '/slot'), 1, 13) as bigint) % cast(ceil((select count(*) from documents) / 65536.0) as bigint),
           doc_id nulls first, text_crc32, size) - 1 as slot,
       cast(s25.shard as integer) as grown_shard
from c join s24 on c.k = s24.k join s25 on c.k = s25.k
"""
