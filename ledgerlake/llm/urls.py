"""URL filter in DataFrame functions only: given rules decide first, gradient-boosted
trees on lexical features decide the rest.

1. *Rules.*  A rule is (host, path, verdict).  It fits its host and all subdomains, if
   the url's path starts with the rule's.  The longest rule (host and path) wins; of
   equal ones that with the longer host, then the one that blocks.  Rules are part of
   the plan, as one CASE.
2. *Labelled urls.*  Any table of urls with a label; the query takes those that the
   rules decide.
3. *Features.*  Nine numbers of a url, each a bin from 0 to 31: length, path depth, share
   of digits, entropy of its characters, number of parameters, labels of the host, and
   three statistics of host suffixes over all labelled urls (the blocked share under the
   last label and under the last three, and how common the last label is).  A labelled
   url's statistics leave out the fifth of the urls that it is in, so a label is never
   its own feature.
4. *Trees.*  Newton boosting of the logistic loss on histograms: each level is one
   grouped sum of gradients by (node, feature, bin), combined map-side, and what the
   driver sees are at most 8 nodes x 9 features x 32 bins.  Gradients, leaves and margins are
   integers (2**-20), so sums are exact in any order and a lost task changes nothing.
5. *Scoring.*  The trees become one expression over one narrow scan.

Bounds: at most about ``train_rows`` labelled urls are fitted on, chosen by a hash of the
url; their distinct feature vectors, with counts, are the training table.  Statistics cover all
labelled urls; only suffixes with a thousandth of them or more are kept (so a thousand at
most, which is why they may be broadcast), all others have the overall share.

Defined results: a null url is an empty one; without ``://`` host and path are empty;
repeated urls count once each in statistics and get a row each; without labelled urls
every margin is 0, and a margin of 0 or less allows; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: (host, path, verdict)
Rule = tuple[str, str, str]
RULES: tuple[Rule, ...] = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"))
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
FEATURES = ("length", "depth", "digits", "entropy", "params", "labels", "rate_1", "rate_3", "common")
BINS, FOLDS, UNIT = 32, 5, 1 << 20
TREES, DEPTH, RATE = 12, 3, 0.4
#: Added to a sum of second derivatives, and the least such sum of a child.
LAMBDA, LEAST = float(UNIT), float(UNIT)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` with A-Z lower-cased, path up to ``?`` or ``#``."""
    url = F.coalesce(url, F.lit(""))
    return (F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1))


def ranked(rules: Sequence[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2] != "block", r))


def decided(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the rule that wins, null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in reversed(ranked(rules)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def hashed(text: Column) -> Column:
    """A number of 52 bits."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def _bin(value: Column) -> Column:
    return F.least(F.lit(BINS - 1), value.cast("int"))


def entropy(url: Column) -> Column:
    """Bits per character: characters are sorted and their runs counted."""
    chars = F.array_sort(F.split(url, ""))
    run = F.aggregate(
        chars, F.struct(F.lit("").alias("c"), F.lit(0.0).alias("n"), F.lit(0.0).alias("s")),
        lambda a, c: F.when(a["c"] == c, F.struct(c.alias("c"), (a["n"] + 1).alias("n"), a["s"].alias("s")))
        .otherwise(F.struct(c.alias("c"), F.lit(1.0).alias("n"), (a["s"] + _xlog(a["n"])).alias("s"))),
        lambda a: a["s"] + _xlog(a["n"]))
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    return F.log(n) / F.log(F.lit(2.0)) - run / n


def _xlog(n: Column) -> Column:
    return n * F.log(F.greatest(n, F.lit(1.0))) / F.log(F.lit(2.0))


def lexical(url: Column) -> list[Column]:
    """The bins of the first six features."""
    url = F.coalesce(url, F.lit(""))
    host, path = split_url(url)
    n = F.greatest(F.length(url), F.lit(1))
    digits = F.length(url) - F.length(F.translate(url, DIGITS, ""))
    query = F.regexp_extract(url, r"://[^/?#]*[^?#]*\?([^#]*)", 1)
    parts = lambda text, by: F.size(F.filter(F.split(text, by), lambda x: x != ""))
    return [_bin(F.floor(F.length(url) / 4)), _bin(parts(path, "/")), _bin(F.floor(F.floor(digits * 1000 / n) / 32)),
            _bin(F.floor(F.floor(entropy(url) * 100 + 0.5) / 16)), _bin(parts(query, "&")), _bin(parts(host, r"\."))]


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


@dataclass
class Statistics:
    """Per host suffix: labelled and blocked urls, in all and in each fold."""
    total: int
    blocked: int
    tables: dict[int, DataFrame]


def statistics(labelled: DataFrame) -> Statistics:
    """``labelled``: url, blocked (0 or 1), with no nulls."""
    base = labelled.select(split_url(F.col("url"))[0].alias("host"), F.pmod(hashed(F.col("url")), F.lit(FOLDS)).alias("fold"), "blocked")
    size = base.agg(F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("b")).first()
    total, blocked = size["n"], size["b"] or 0
    tables = {}
    for k in (1, 3):
        one = base.select(_suffix(F.col("host"), k).alias(f"suffix_{k}"), "fold", "blocked")
        counts = one.groupBy(f"suffix_{k}").agg(
            F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("b"),
            F.array(*[F.count(F.when(F.col("fold") == f, 1)) for f in range(FOLDS)]).alias("n_in"),
            F.array(*[F.sum(F.when(F.col("fold") == f, F.col("blocked")).otherwise(0)) for f in range(FOLDS)]).alias("b_in"))
        counts = counts.where(F.col("n") * 1000 >= total).select(
            f"suffix_{k}", *[F.col(c).alias(f"{c}_{k}") for c in ("n", "b", "n_in", "b_in")])
        tables[k] = stored(counts, "suffixes")
    return Statistics(total, blocked, tables)


def featured(urls: DataFrame, known: Statistics, fold: Column | None = None) -> DataFrame:
    """``urls`` (with ``url``) and the bins ``f0..f8``.  With ``fold``, a row's own fold is
    left out of its statistics."""
    df = urls
    for i, c in enumerate(lexical(F.col("url"))):
        df = df.withColumn(f"f{i}", c)
    host = split_url(F.col("url"))[0]
    for k in (1, 3):
        # a thousand rows at most, see Statistics
        df = df.withColumn(f"suffix_{k}", _suffix(host, k)).join(F.broadcast(known.tables[k]), f"suffix_{k}", "left")
    share = F.lit((known.blocked + 1.0) / (known.total + 2.0))
    for at, k in ((6, 1), (7, 3)):
        n, b = F.coalesce(F.col(f"n_{k}"), F.lit(0)), F.coalesce(F.col(f"b_{k}"), F.lit(0))
        if fold is not None:
            n, b = n - F.coalesce(F.col(f"n_in_{k}")[fold], F.lit(0)), b - F.coalesce(F.col(f"b_in_{k}")[fold], F.lit(0))
        df = df.withColumn(f"f{at}", _bin(F.floor((b + share * 4.0) / (n + 4.0) * 31.0)))
    df = df.withColumn("f8", _bin(F.floor(F.coalesce(F.col("n_1"), F.lit(0)) * 31.0 / max(known.total, 1))))
    return df.drop(*[f"{c}_{k}" for k in (1, 3) for c in ("suffix", "n", "b", "n_in", "b_in")])


#: A tree: splits of nodes 1..2**DEPTH - 1 as (feature, bin), a row goes left (2 * node)
#: if its bin is at most that; and the values of its leaves, nodes 2**DEPTH and on.
Tree = tuple[dict[int, tuple[int, int]], dict[int, int]]
NO_SPLIT = (0, BINS - 1)


def best_splits(rows: Sequence, nodes: range) -> tuple[dict[int, tuple[int, int]], dict[int, tuple[float, float]]]:
    """The split of each node with the greatest gain, ties to the first feature and bin;
    and the sums (g, h) of the children that the splits make."""
    hist: dict[tuple[int, int], dict[int, tuple[float, float]]] = {}
    for r in rows:
        hist.setdefault((r["node"], r["f"]), {})[r["bin"]] = (float(r["g"]), float(r["h"]))
    best: dict[int, tuple[float, int, int]] = {}
    sums: dict[int, tuple[float, float]] = {}
    for (node, f), bins in sorted(hist.items()):
        g, h = sum(x for x, _ in bins.values()), sum(x for _, x in bins.values())
        if f == 0 and node not in best:
            sums[2 * node] = g, h
        gl = hl = 0.0
        for b in sorted(bins):
            gl, hl = gl + bins[b][0], hl + bins[b][1]
            gr, hr = g - gl, h - hl
            if hl < LEAST or hr < LEAST:
                continue
            gain = gl * gl / (hl + LAMBDA) + gr * gr / (hr + LAMBDA) - g * g / (h + LAMBDA)
            if gain > best.get(node, (0.0,))[0]:
                best[node] = (gain, f, b)
                sums[2 * node], sums[2 * node + 1] = (gl, hl), (gr, hr)
    return {n: best[n][1:] if n in best else NO_SPLIT for n in nodes}, sums


def leaf_of(splits: dict[int, tuple[int, int]]) -> Column:
    """The node that a row comes to."""
    def below(node: int) -> Column:
        if node not in splits:
            return F.lit(node)
        f, b = splits[node]
        return F.when(F.col(f"f{f}") <= b, below(2 * node)).otherwise(below(2 * node + 1))
    return below(1)


def margin_of(trees: Sequence[Tree]) -> Column:
    """The sum of the leaves' values: log-odds of block in units of 2**-20."""
    def below(tree: Tree, node: int) -> Column:
        if node not in tree[0]:
            return F.lit(tree[1].get(node, 0)).cast("long")
        f, b = tree[0][node]
        return F.when(F.col(f"f{f}") <= b, below(tree, 2 * node)).otherwise(below(tree, 2 * node + 1))
    margin = F.lit(0).cast("long")
    for t in trees:
        margin = margin + below(t, 1)
    return margin


def fit(vectors: DataFrame, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> list[Tree]:
    """Boosted trees on ``vectors``: f0..f8, n (urls) and blocked (of them)."""
    found: list[Tree] = []
    cols = [f"f{i}" for i in range(len(FEATURES))]
    table = vectors.select(*cols, "n", "blocked", F.lit(0).cast("long").alias("m"))
    for _ in range(trees):
        p = 1.0 / (1.0 + F.exp(-F.col("m") / float(UNIT)))
        table = stored(table.select(
            *cols, "n", "blocked", "m",
            (F.col("n") * F.floor(p * float(UNIT) + 0.5) - F.col("blocked") * UNIT).alias("g"),
            (F.col("n") * F.floor(p * (1.0 - p) * float(UNIT) + 0.5)).alias("h")), "boosting")
        splits: dict[int, tuple[int, int]] = {}
        for level in range(depth):
            bins = F.posexplode(F.array(*cols)).alias("f", "bin")
            hist = (table.select(leaf_of(splits).alias("node"), "g", "h", bins)
                    .groupBy("node", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")))
            more, sums = best_splits(hist.collect(), range(1 << level, 2 << level))
            splits |= more
        found.append((splits, {node: math.floor(-g * rate * UNIT / (h + LAMBDA) + 0.5) for node, (g, h) in sums.items()}))
        table = table.select(*cols, "n", "blocked", (F.col("m") + margin_of([found[-1]])).alias("m"))
    return found


def train(labelled: DataFrame, train_rows: int = 50_000, trees: int = TREES) -> tuple[Statistics, list[Tree]]:
    """Statistics over all of ``labelled`` (url, blocked) and ``trees`` on about ``train_rows`` of it."""
    known = statistics(labelled)
    rows = labelled
    if known.total > train_rows:
        rows = rows.where(hashed(F.col("url")) < int((1 << 52) * train_rows / known.total))
    fold = F.pmod(hashed(F.col("url")), F.lit(FOLDS)).cast("int")
    vectors = featured(rows, known, fold).groupBy(*[f"f{i}" for i in range(len(FEATURES))]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("blocked").cast("long").alias("blocked"))
    return known, fit(vectors, trees) if known.total else []


def judge(pages: DataFrame, *, rules: Sequence[Rule] = RULES, labelled: DataFrame | None = None, id_col: str = "page_id",
          url_col: str = "url", train_rows: int = 50_000, trees: int = TREES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the ``margin`` of the trees
    (above 0: block).  ``labelled``: url, blocked; without it the urls that rules decide."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    rule, verdict = decided(F.col("host"), F.col("path"), rules)
    base = (pages.select(F.col(id_col).alias("page_id"), url.alias("url"))
            .withColumn("host", split_url(F.col("url"))[0]).withColumn("path", split_url(F.col("url"))[1])
            .withColumn("rule", rule).withColumn("given", verdict))
    if labelled is None:
        labelled = base.where(F.col("given").isNotNull()).select("url", (F.col("given") == "block").cast("int").alias("blocked"))
    known, fitted = train(labelled, train_rows, trees)
    scored = featured(base, known).withColumn("margin", margin_of(fitted))
    return scored.select("page_id", "host", "path", "rule", F.coalesce(
        "given", F.when(F.col("margin") > 0, "block").otherwise("allow")).alias("verdict"), "margin")


def _sql() -> str:
    """The query in SQL: vectors of weight 0 (urls to score) go through the trees with those
    of the labelled urls, one group of WITH clauses per level."""
    n = len(FEATURES)
    fs = ", ".join(f"f{i}" for i in range(n))
    arr = "[" + ", ".join(f"f{i}" for i in range(n)) + "]"
    word = "cast('0x' || substr(md5(url), 1, 13) as bigint)"
    fits = " ".join(
        f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{h}{p}={v}'" for h, p, v in ranked(RULES))

    def parts(text: str, by: str) -> str:
        return f"len(list_filter(string_split({text}, '{by}'), lambda x: x <> ''))"

    def suffix(k: int) -> str:
        return f"array_to_string(list_slice(string_split(host, '.'), -{k}, -1), '.')"
    lex = f"""
      least(31, length(url) // 4) as f0, least(31, {parts('path', '/')}) as f1,
      least(31, (length(url) - length(translate(url, '{DIGITS}', ''))) * 1000 // greatest(length(url), 1) // 32) as f2,
      least(31, cast(floor(floor(coalesce(list_entropy(string_split(url, '')), 0) * 100 + 0.5) / 16) as integer)) as f3,
      least(31, {parts("regexp_extract(url, '://[^/?#]*[^?#]*[?]([^#]*)', 1)", '&')}) as f4, least(31, {parts('host', '.')}) as f5"""

    def rate(k: int, own: bool) -> str:
        less = (f" - coalesce(s{k}.n_in[fold + 1], 0)", f" - coalesce(s{k}.b_in[fold + 1], 0)") if own else ("", "")
        return (f"least(31, cast(floor((coalesce(s{k}.b, 0){less[1]} + t.share * 4.0) / "
                f"(coalesce(s{k}.n, 0){less[0]} + 4.0) * 31.0) as integer))")

    def features(rows: str, own: bool) -> str:
        return (f"select x.*, {rate(1, own)} as f6, {rate(3, own)} as f7, "
                f"least(31, cast(floor(coalesce(s1.n, 0) * 31.0 / greatest(t.n, 1)) as integer)) as f8 "
                f"from {rows} x cross join t left join s1 on s1.suffix = x.suffix_1 left join s3 on s3.suffix = x.suffix_3")
    ctes = [f"""a as materialized (
      select page_id, url, host, path, string_split(fit, '=')[1] as rule, string_split(fit, '=')[2] as given, {word} % {FOLDS} as fold,
             {suffix(1)} as suffix_1, {suffix(3)} as suffix_3, {lex}
      from (select *, case {fits} end as fit from (
        select page_id, url, translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host,
               regexp_extract(url, '://[^/?#]*([^?#]*)', 1) as path
        from (select page_id, coalesce(url, '') as url from pages))))""",
            "l as (select *, case when given = 'block' then 1 else 0 end as blocked from a where given is not null)",
            "t as (select count(*) as n, (coalesce(sum(blocked), 0) + 1.0::double) / (count(*) + 2.0::double) as share from l)"]
    for k in (1, 3):
        ins = ", ".join(f"count(*) filter (fold = {f})" for f in range(FOLDS))
        bins = ", ".join(f"coalesce(sum(blocked) filter (fold = {f}), 0)" for f in range(FOLDS))
        ctes.append(f"s{k} as materialized (select suffix_{k} as suffix, count(*) as n, sum(blocked) as b, [{ins}] as n_in, [{bins}] as b_in "
                    f"from l group by 1 having count(*) * 1000 >= (select n from t))")
    ctes += [f"scored as materialized ({features('a', False)})", f"trained as ({features('l', True)})",
             f"m0 as materialized (select {fs}, sum(n) as n, sum(blocked) as blocked, 0::bigint as m from ("
             f"select {fs}, 1 as n, blocked from trained union all select {fs}, 0, 0 from scored) group by {fs})"]
    for i in range(TREES):
        ctes.append(f"p{i}_0 as materialized (select *, 1 as node, "
                    f"n * cast(floor(p * {UNIT}.0::double + 0.5) as bigint) - blocked * {UNIT} as g, "
                    f"n * cast(floor(p * (1.0 - p) * {UNIT}.0::double + 0.5) as bigint) as h "
                    f"from (select *, 1.0::double / (1.0 + exp(-m / {UNIT}.0::double)) as p from m{i}))")
        for d in range(DEPTH):
            ctes.append(f"""b{i}_{d} as materialized (
              select node, f, bin from (
                select node, f, bin, row_number() over (partition by node order by gain desc, f, bin) as r, gain from (
                  select node, f, bin, hl, h - hl as hr,
                         gl * gl / (hl + {LAMBDA}::double) + (g - gl) * (g - gl) / (h - hl + {LAMBDA}::double) - g * g / (h + {LAMBDA}::double) as gain
                  from (select node, f, bin, cast(sum(g) over w as double) as gl, cast(sum(h) over w as double) as hl,
                               cast(sum(g) over (partition by node, f) as double) as g, cast(sum(h) over (partition by node, f) as double) as h
                        from (select node, f, bin, sum(g) as g, sum(h) as h
                              from (select node, unnest(range({n})) as f, unnest({arr}) as bin, g, h from p{i}_{d} where n > 0) group by all)
                        window w as (partition by node, f order by bin)))
                where hl >= {LEAST}::double and hr >= {LEAST}::double)
              where r = 1 and gain > 0)""")
            ctes.append(f"p{i}_{d + 1} as materialized (select p.* replace (2 * p.node + case when {arr}[coalesce(b.f, 0) + 1] <= coalesce(b.bin, 31) "
                        f"then 0 else 1 end as node) from p{i}_{d} p left join b{i}_{d} b on b.node = p.node)")
        ctes.append(f"v{i} as materialized (select node, cast(floor(-cast(sum(g) as double) * {RATE}::double * {UNIT}::double / "
                    f"(cast(sum(h) as double) + {LAMBDA}::double) + 0.5) as bigint) as v from p{i}_{DEPTH} where n > 0 group by node)")
        ctes.append(f"m{i + 1} as materialized (select {fs}, n, blocked, m + coalesce(v, 0) as m from p{i}_{DEPTH} p left join v{i} v on v.node = p.node)")
    same = " and ".join(f"s.f{i} = m.f{i}" for i in range(n))
    return ("with " + ",\n".join(ctes) + f"""
select page_id, host, path, rule, coalesce(given, case when m > 0 then 'block' else 'allow' end) as verdict, m as margin
from scored s join m{TREES} m on {same}""")


SQL = _sql()
