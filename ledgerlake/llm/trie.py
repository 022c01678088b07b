"""Prefix trie of rebuilt conversations, with counts and sums over subtrees.

1. *Turns.*  Every (role, text) becomes a SHA-256 and a number of bytes; texts go no
   further.  Turns are numbered in their conversation within stretches of ``STRETCH`` turn
   numbers, the stretches offset by their counts.
2. *Rebuilding.*  A conversation takes the first turns of its base from a table of at
   most 8 turns of each base.
3. *Prefix digests.*  A prefix's digest is two sums of 62-bit hashes of (position, turn): running
   sums, so a long conversation is no single task.  Distinct digests are the nodes.  Each
   node is verified: all its rows agree on turn, depth and parent digest, which by induction
   over the depth makes equal digests equal sequences; a collision makes it start over with
   other hashes.
4. *Chains.*  A node belongs to its smallest member, so a conversation's own nodes are the
   end of its path and (conv_id, depth) names a node.  What a chain sums to is added once
   to each chain above it, at the depth where the paths part.
5. *Node table.*  Nodes are dealt to shards by chain and stretch of depths, about
   ``shard_nodes`` to a shard.  A shard gives its digests slots by a minimal perfect
   hash, each verified against the digest it stores; counts are scattered into flat arrays and
   accumulated through the parents' slots from the deepest depth up.
6. *Ends.*  Sorted ids are joined to strings of up to ``STRETCH`` ids in Spark; a node's
   SHA-256 is fed with them one after the other, in a stream of bounded memory.

Nodes with more than 1/2,000 of all path rows (so fewer than 2,000 nodes) meet their rows by a
broadcast, all others by a shuffle in which no key is larger than that.

Defined results: rows with a null conv_id take no part; null roles and texts are empty;
turns of equal number are in the order of their SHA-256, repeated rows are turns of
their own; ``%`` keeps the sign of a negative id; an empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .common import mix, stored

STRETCH = 1024
#: Turns taken from the base are fewer than HEADS; bases are the ids that GROUP divides.
HEADS, GROUP = 9, 5
HOT = 2000
U64 = np.uint64
KEY = ["depth", "k1", "k2"]


def turns(conversations: DataFrame, *, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, pos, sha, bytes): turns numbered from 1 in each conversation."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    one = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("sha"),
        F.octet_length(text).cast("long").alias("bytes"))
    one = one.withColumn("part", F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(1 << 62))))
    numbered = one.withColumn("pos", F.row_number().over(Window.partitionBy("conv", "part").orderBy("turn", "sha")).cast("long"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = one.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n")).select("conv", "part", F.sum("n").over(before).alias("off"))
    return numbered.join(offset.where("off > 0"), ["conv", "part"], "left").select(
        "conv", (F.col("pos") + F.coalesce("off", F.lit(0))).alias("pos"), "sha", "bytes")


def taken(conv: Column) -> Column:
    """Turns that a conversation takes from its base, if the base has as many."""
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``numbered`` (a stored table): (conv, depth, sha, bytes, last) of the rebuilt turns, and
    (conv, turns) of all conversations."""
    size = numbered.groupBy("conv").agg(F.max("pos").alias("own"))
    base = F.col("conv") - F.col("conv") % GROUP
    info = (size.withColumn("base", base)
            .join(size.where(F.col("conv") % GROUP == 0).select(F.col("conv").alias("base"), F.col("own").alias("base_own")), "base", "left")
            .withColumn("head", F.least(taken(F.col("conv")), F.coalesce("base_own", F.lit(0))))
            .withColumn("skip", taken(F.col("conv")))
            .withColumn("turns", F.col("head") + F.greatest(F.col("own") - F.col("skip"), F.lit(0))))
    info = stored(info.select("conv", "base", "head", "skip", F.when(F.col("conv") == F.col("base"), F.col("own")).otherwise(F.col("turns")).alias("turns")), "rebuilt")
    heads = (numbered.where(F.col("conv") % GROUP == 0).where(F.col("pos") < HEADS).withColumnRenamed("conv", "base")
             .join(info.where("conv <> base"), "base").where("pos <= head")
             .select("conv", F.col("pos").alias("depth"), "sha", "bytes", "turns"))
    is_base = F.col("conv") == F.col("base")
    own = (numbered.join(info, "conv").where(is_base | (F.col("pos") > F.col("skip")))
           .select("conv", F.when(is_base, F.col("pos")).otherwise(F.col("pos") - F.col("skip") + F.col("head")).alias("depth"), "sha", "bytes", "turns"))
    rows = heads.unionByName(own).select("conv", "depth", "sha", "bytes", (F.col("depth") == F.col("turns")).alias("last"))
    return rows, info.select("conv", "turns")


def paths(rows: DataFrame, convs: DataFrame, seed: int) -> DataFrame:
    """``rows`` and a row of depth 0 for each conversation, with the digests k1, k2 of the
    prefix that ends there and p1, p2 of the one before."""
    number = lambda *c: F.shiftrightunsigned(F.xxhash64(F.lit(seed), *c), 2).cast("decimal(20,0)")
    one = rows.withColumn("y1", number("depth", "sha")).withColumn("y2", number("sha", "depth")).withColumn(
        "part", F.floor((F.col("depth") - 1) / STRETCH))
    within = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = one.groupBy("conv", "part").agg(F.sum("y1").alias("y1"), F.sum("y2").alias("y2")).select(
        "conv", "part", F.sum("y1").over(before).alias("o1"), F.sum("y2").over(before).alias("o2")).where("o1 is not null")
    summed = one.select("*", F.sum("y1").over(within).alias("s1"), F.sum("y2").over(within).alias("s2")).join(offset, ["conv", "part"], "left")
    low = lambda c: F.pmod(c.cast("decimal(38,0)"), F.lit(1 << 62).cast("decimal(38,0)")).cast("long")
    total = {i: F.col(f"s{i}") + F.coalesce(F.col(f"o{i}"), F.lit(0)) for i in (1, 2)}
    made = summed.select("conv", "depth", *[low(total[i]).alias(f"k{i}") for i in (1, 2)],
                         *[low(total[i] - F.col(f"y{i}")).alias(f"p{i}") for i in (1, 2)], "sha", "bytes", "last")
    root = convs.select("conv", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in ("k1", "k2", "p1", "p2")],
                        F.lit("").alias("sha"), F.lit(0).cast("long").alias("bytes"), (F.col("turns") == 0).alias("last"))
    return made.unionByName(root)


def distinct_nodes(rows: DataFrame) -> tuple[DataFrame, int]:
    """The nodes of ``rows`` (a stored table), and how many of them are collisions."""
    same = F.lit(True)
    for c in ("sha", "p1", "p2"):
        same &= F.min(c) == F.max(c)
    nodes = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("owner"), F.max("bytes").alias("bytes"),
                                   F.min("p1").alias("p1"), F.min("p2").alias("p2"), same.alias("same"))
    bad = Observation()
    table = stored(nodes, "nodes", bad, F.count(F.when(~F.col("same"), 1)).alias("bad"))
    return table.drop("same"), bad.get["bad"]


def owners(rows: DataFrame, nodes: DataFrame, total: int) -> DataFrame:
    """(conv, depth, last, owner): the node of each row, by its smallest member."""
    hot = F.col("n") * HOT > total
    narrow = rows.select("conv", "last", *KEY)
    often = F.broadcast(nodes.where(hot).select(*KEY, F.col("owner").alias("hot_owner")))  # fewer than HOT rows
    marked = narrow.join(often, KEY, "left")
    return (marked.where("hot_owner is null").join(nodes.where(~hot).select(*KEY, "owner"), KEY).select("conv", "depth", "last", "owner")
            .unionByName(marked.where("hot_owner is not null").select("conv", "depth", "last", F.col("hot_owner").alias("owner"))))


class Slots:
    """Minimal perfect hash of distinct 124-bit keys.  Each level tries a bit array; keys that
    land alone keep their place, the others go on to the next.  A key's slot is the number
    of taken places before its own.  ``find`` verifies the key that the slot stores."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        at, base = np.arange(len(k1)), 0
        self.slot = np.empty(len(k1), np.int64)
        while len(at):
            size = 2 * len(at) + 1
            place = self._place(k1[at], k2[at], len(self.levels), size)
            taken_once = np.bincount(place, minlength=size) == 1
            rank = np.cumsum(taken_once) - 1 + base
            self.levels.append((taken_once, rank))
            alone = taken_once[place]
            self.slot[at[alone]] = rank[place[alone]]
            base += int(taken_once.sum())
            at = at[~alone]
            if len(self.levels) > 200:
                raise ValueError("keys are not distinct")
        self.key1, self.key2 = np.empty_like(k1), np.empty_like(k2)
        self.key1[self.slot], self.key2[self.slot] = k1, k2

    @staticmethod
    def _place(k1: np.ndarray, k2: np.ndarray, level: int, size: int) -> np.ndarray:
        h = mix(k1.view(U64) + U64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) ^ k2.view(U64)
        return (mix(h) % U64(size)).astype(np.int64)

    def find(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """Slots of keys, -1 for keys that are not in the table."""
        out = np.full(len(k1), -1, np.int64)
        at = np.arange(len(k1))
        for level, (taken_once, rank) in enumerate(self.levels):
            place = self._place(k1[at], k2[at], level, len(taken_once))
            here = taken_once[place]
            out[at[here]] = rank[place[here]]
            at = at[~here]
        found = np.flatnonzero(out >= 0)
        wrong = (self.key1[out[found]] != k1[found]) | (self.key2[out[found]] != k2[found])
        out[found[wrong]] = -1
        return out


def accumulate(nodes: pd.DataFrame) -> pd.DataFrame:
    """Sums over subtrees within one shard: ``leaves`` and ``saved`` of each node and of all below it."""
    k1, k2 = nodes["k1"].to_numpy(np.int64), nodes["k2"].to_numpy(np.int64)
    table = Slots(k1, k2)
    depth = nodes["depth"].to_numpy(np.int64)
    inside = (nodes["parent"].fillna(-1).to_numpy(np.int64) == nodes["owner"].to_numpy(np.int64)) & nodes["parent"].notna().to_numpy() & (depth % STRETCH != 0)
    parent = np.full(len(nodes), -1, np.int64)
    own = np.flatnonzero(inside)
    parent[table.slot[own]] = table.find(nodes["p1"].to_numpy(np.int64)[own], nodes["p2"].to_numpy(np.int64)[own])
    flat: dict[str, np.ndarray] = {"depth": depth, "leaves": nodes["leaves"].to_numpy(np.int64), "saved": nodes["saved"].to_numpy(np.int64)}
    for c, values in flat.items():
        flat[c] = np.empty(len(nodes), np.int64)
        flat[c][table.slot] = values
    order = np.argsort(-flat["depth"], kind="stable")
    order = order[parent[order] >= 0]
    for group in np.split(order, np.flatnonzero(np.diff(flat["depth"][order])) + 1):
        for c in ("leaves", "saved"):
            np.add.at(flat[c], parent[group], flat[c][group])
    return nodes[["owner", "depth", "parent", "n", "children"]].assign(leaves=flat["leaves"][table.slot], saved=flat["saved"][table.slot])


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(owner, depth, ids) in order to (owner, depth, ends): one running SHA-256."""
    at, sha = None, None
    for b in batches:
        done = []
        for owner, depth, ids in zip(b["owner"], b["depth"], b["ids"]):
            if (owner, depth) == at:
                sha.update(b",")
            else:
                if at:
                    done.append((*at, sha.hexdigest()))
                at, sha = (owner, depth), hashlib.sha256()
            sha.update(ids.encode())
        if done:
            yield pd.DataFrame(done, columns=["owner", "depth", "ends"])
    if at:
        yield pd.DataFrame([(*at, sha.hexdigest())], columns=["owner", "depth", "ends"])


def ends(owned: DataFrame) -> DataFrame:
    """(owner, depth, ends): SHA-256 of the ids of the conversations that end at a node."""
    strings = owned.where("last").groupBy("owner", "depth", F.floor(F.col("conv") / STRETCH).alias("part")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    return (strings.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "part").select("owner", "depth", "ids")
            .mapInPandas(_digest, "owner bigint, depth bigint, ends string"))


def prefix_trie(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", shard_nodes: int = 1 << 16) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    numbered = stored(turns(conversations, conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col), "turns")
    rows, convs = rebuilt(numbered)
    rows = stored(rows, "rebuilt-turns")
    for seed in range(1, 9):
        path = stored(paths(rows, convs, seed), "paths")
        nodes, bad = distinct_nodes(path)
        if not bad:
            break
    else:
        raise RuntimeError("prefix digests collide under eight hashes")
    owned = stored(owners(path, nodes, path.count()), "owners")

    above = owned.select(F.col("conv").alias("owner"), (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    placed = nodes.join(above, ["owner", "depth"], "left")
    children = placed.where("depth > 0").groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("children"))
    valued = stored(placed.join(children, ["owner", "depth"], "left").select(
        "owner", *KEY, "p1", "p2", "parent", "n", F.coalesce("children", F.lit(0)).alias("children"),
        F.col("children").isNull().cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("bytes")).alias("saved")), "trie")

    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    chain = valued.groupBy("owner").agg(*sums).withColumnRenamed("owner", "conv")
    parts_at = owned.where("owner <> conv").groupBy("conv", "owner").agg(F.max("depth").alias("depth"))
    joining = parts_at.join(chain, "conv").groupBy("owner", "depth").agg(*sums)
    both = valued.select("owner", "depth", "leaves", "saved").unionByName(joining)
    part = F.floor(F.col("depth") / STRETCH)
    later = Window.partitionBy("owner").orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = (both.groupBy("owner", part.alias("part")).agg(*sums)
               .select("owner", "part", F.sum("leaves").over(later).alias("leaves"), F.sum("saved").over(later).alias("saved"))
               .where("leaves is not null").select("owner", (F.col("part") * STRETCH + STRETCH - 1).alias("depth"), "leaves", "saved"))
    more = joining.unionByName(carried).groupBy("owner", "depth").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))

    shards = max(1, -(-valued.count() // shard_nodes))
    table = valued.join(more, ["owner", "depth"], "left").select(
        "owner", *KEY, "p1", "p2", "parent", "n", "children", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"), F.pmod(F.xxhash64("owner", part), F.lit(shards)).alias("shard"))
    summed = table.groupBy("shard").applyInPandas(
        accumulate, "owner bigint, depth bigint, parent bigint, n bigint, children bigint, leaves bigint, saved bigint")
    return summed.join(ends(owned), ["owner", "depth"], "left").select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


SQL = """
with tab as (
  select list(crc order by i) as t from (
    select i, list_reduce([cast(i as bigint)] || [cast(0 as bigint) for k in range(8)],
                          lambda a, x: case when a & 1 = 1 then xor(a >> 1, cast(3988292384 as bigint)) else a >> 1 end) as crc
    from range(256) as r(i))),
turn_of as materialized (
  select c, s, b, row_number() over (partition by c order by turn nulls first, s) as pos from (
    select conv_id as c, turn, sha256(strlen(role) || ':' || role || text) as s, strlen(text) as b
    from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null))),
conv as materialized (
  select c, c - c % 5 as base,
         xor(list_reduce([cast(4294967295 as bigint)]
                         || [cast('0x' || substr(x, cast(2 * i + 1 as bigint), 2) as bigint) for i in range(len(x) // 2)],
                         lambda a, y: xor(a >> 8, tab.t[xor(a & 255, y) + 1])), cast(4294967295 as bigint)) % 9 as h
  from (select distinct c, lower(hex(encode(cast(c as varchar)))) as x from turn_of), tab),
seq as (
  select c.c, 0 as own, t.pos, t.s, t.b from conv c join turn_of t on t.c = c.base and t.pos <= c.h
  union all select c.c, 1, t.pos, t.s, t.b from conv c join turn_of t on t.c = c.c and t.pos > c.h),
path as materialized (
  select c, b, row_number() over w as d, string_agg(s, '') over w as p from seq window w as (partition by c order by own, pos)),
member as materialized (
  select c, d, p, b from path union all select c, 0, '', 0 from conv),
length_of as (select c, max(d) as n from member group by c),
node as materialized (
  select d, p, min(c) as c, count(*) as n, max(b) as b, case when d > 0 then substr(p, 1, 64 * (d - 1)) end as up from member group by d, p),
kids as materialized (
  select d, p, c, n, up, (n - 1) * b as saved, (select count(*) from node k where k.d = node.d + 1 and k.up = node.p) as children from node),
sub as (
  select v.p, count(*) filter (u.children = 0) as leaves, sum(u.saved) as saved
  from kids v join kids u on starts_with(u.p, v.p) group by v.p),
ended as (
  select m.p, string_agg(cast(m.c as varchar), ',' order by m.c) as ids from member m join length_of l on l.c = m.c and l.n = m.d group by m.p)
select v.c as conv_id, v.d as depth, up.c as parent_conv_id, v.n as n_convs, v.children as n_children, sub.leaves as n_leaves,
       cast(sub.saved as bigint) as saved_tokens, sha256(coalesce(ended.ids, '')) as ends_sha256
from kids v join sub on sub.p = v.p left join node up on up.p = v.up left join ended on ended.p = v.p
"""
