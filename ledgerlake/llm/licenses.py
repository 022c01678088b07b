"""Licence scan in DataFrame functions only.

1. *Units.*  Documents that speak of a licence at all give units: every line that does, alone
   and with the non-empty lines beside it (a statement may be broken over lines), and the
   whole text.
2. *Match.*  Units and templates are sparse TF-IDF vectors over words (idf from the templates,
   words beyond them weigh as the rarest).  Lines and windows meet the header statements, with
   plain counts; whole texts meet the licence texts, with the logarithm of counts.  The best
   header of ``least`` or more is the document's licence, else its best licence text of ``least_file``
   or more.
3. *Files.*  A document that matches a licence text, or in which matching lines hold
   ``file_share`` of all words or more, is a licence file: it speaks for its directory.  A
   directory's licence is that of most of its licence files.
4. *Inheritance.*  A document without a licence of its own takes that of its nearest
   ancestor directory that has one, found by joining directories with the paths above
   them.  Only distinct directories take part.

The documents table has no paths; the query lays documents out in a tree of three levels:
``/source/lang/n/id`` with n = id div 64; the first of each 64 one level up, in
``/source/lang``; the first of each 1,024 in ``/source``.

Defined results: null and empty texts match nothing; a null source or language is the
directory ``_``, a null id the file ``_``; ties go to the licence first in the alphabet; every
row is judged by its own text, also where ids or paths repeat, and repeated licence files
count each; without a match the licence is null and how is "none".
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Short statements of licences as files carry them (fixed values).
TEMPLATES = {
    "AGPL-3.0": "licensed under the gnu affero general public license version 3",
    "Apache-2.0": "licensed under the apache license version 2.0",
    "BSD-3-Clause": "redistribution and use in source and binary forms are permitted under the bsd 3 clause license",
    "CC-BY-4.0": "licensed under the creative commons attribution license cc by 4.0",
    "CC-BY-NC-4.0": "licensed under the creative commons attribution noncommercial license cc by nc 4.0",
    "CC-BY-SA-4.0": "licensed under the creative commons attribution sharealike license cc by sa 4.0",
    "GPL-2.0": "this work is licensed under the gnu general public license version 2",
    "GPL-3.0": "this work is licensed under the gnu general public license version 3",
    "ISC": "permission to use copy modify and distribute under the isc license",
    "LGPL-3.0": "licensed under the gnu lesser general public license version 3",
    "MIT": "released under the mit license",
    "MPL-2.0": "subject to the terms of the mozilla public license version 2.0",
    "Unlicense": "released into the public domain under the unlicense",
}
#: Licence texts, long ones by their opening (fixed values).
FILES = {
    "Apache-2.0": """
        Apache License Version 2.0, January 2004 TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions.
        "License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9
        of this document. "Licensor" shall mean the copyright owner or entity authorized by the copyright owner that is granting
        the License. "Legal Entity" shall mean the union of the acting entity and all other entities that control, are controlled
        by, or are under common control with that entity. "You" (or "Your") shall mean an individual or Legal Entity exercising
        permissions granted by this License. "Source" form shall mean the preferred form for making modifications, including but
        not limited to software source code, documentation source, and configuration files. "Work" shall mean the work of
        authorship, whether in Source or Object form, made available under the License, as indicated by a copyright notice that is
        included in or attached to the work.""",
    "BSD-2-Clause": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
        the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
        EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
        DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
        LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
        THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
        the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
        3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
        CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS
        BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
        PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
        ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY
        WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "GPL-2.0": """
        GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Everyone is permitted to copy and distribute verbatim copies of this license
        document, but changing it is not allowed. Preamble The licenses for most software are designed to take away your freedom to
        share and change it. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change
        free software--to make sure the software is free for all its users. When we speak of free software, we are referring to
        freedom, not price. Our General Public Licenses are designed to make sure that you have the freedom to distribute copies of
        free software (and charge for this service if you wish), that you receive source code or can get it if you want it, that you
        can change the software or use pieces of it in new free programs; and that you know you can do these things.""",
    "GPL-3.0": """
        GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Everyone is permitted to copy and distribute verbatim copies of this
        license document, but changing it is not allowed. Preamble The GNU General Public License is a free, copyleft license for
        software and other kinds of works. The licenses for most software and other practical works are designed to take away your
        freedom to share and change the works. By contrast, the GNU General Public License is intended to guarantee your freedom to
        share and change all versions of a program--to make sure it remains free software for all its users. When we speak of free
        software, we are referring to freedom, not price. Our General Public Licenses are designed to make sure that you have the
        freedom to distribute copies of free software (and charge for them if you wish), that you receive source code or can get it
        if you want it, that you can change the software or use pieces of it in new free programs, and that you know you can do
        these things.""",
    "ISC": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
        THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
        WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
        ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
        shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
        ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software
        dedicate any and all copyright interest in the software to the public domain.""",
}
SPEAKS = r"(?i)licen[cs]e|spdx|copyright|\bcc[ -]by\b|public domain|permission is hereby|redistribution and use"
WORD = r"([a-z0-9]+)"
HEADER, TEXT = "header", "file"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD))


def template_terms() -> tuple[list[tuple[str, str, str, float]], dict[str, float], float]:
    """(kind, licence, term, weight) of the unit TF-IDF vectors of all templates, the idf of
    their words, and that of any other word."""
    bags = {(HEADER, k): Counter(re.findall(WORD, v)) for k, v in TEMPLATES.items()}
    bags |= {(TEXT, k): Counter(re.findall(WORD, v.lower())) for k, v in FILES.items()}
    df = Counter(t for b in bags.values() for t in b)
    idf = {t: math.log((1 + len(bags)) / (1 + n)) + 1 for t, n in sorted(df.items())}
    out = []
    for (kind, k), b in sorted(bags.items()):
        x = {t: (float(n) if kind == HEADER else 1 + math.log(n)) * idf[t] for t, n in sorted(b.items())}
        norm = math.sqrt(sum(v * v for v in x.values()))
        out += [(kind, k, t, v / norm) for t, v in x.items()]
    return out, idf, math.log(1 + len(bags)) + 1


def units(marked: DataFrame) -> DataFrame:
    """(row, kind, line, n, w): the words of every unit of ``marked`` (row, text).  A window's n is 0."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    unit = lambda kind, line, n, text: F.struct(F.lit(kind).alias("kind"), line.alias("line"), n.alias("counts"), text.alias("text"))
    one = F.transform(lines, lambda x, i: F.when(x.rlike(SPEAKS), F.array(
        unit(HEADER, i, F.lit(1), x),
        unit(HEADER, i, F.lit(0), F.array_join(F.slice(lines, F.greatest(i, F.lit(1)), F.when(i > 0, 3).otherwise(2)), " ")))))
    all_ = F.concat(F.flatten(F.filter(one, lambda x: x.isNotNull())), F.array(unit(TEXT, F.lit(0), F.lit(1), F.col("text"))))
    return marked.select("row", F.inline(all_)).select("row", "kind", "line", "counts", words(F.col("text")).alias("w")).withColumn(
        "n", F.when(F.col("counts") == 1, F.size("w")).otherwise(0).cast("long"))


def matches(marked: DataFrame, least: float, least_file: float) -> DataFrame:
    """(row, kind, line, counts, n, license, cosine) of the units that match a template."""
    spark = marked.sparkSession
    given, idf, unseen = template_terms()
    # as many rows as the templates have words: a fixed size, so they may be broadcast
    terms = F.broadcast(spark.createDataFrame(given, "kind string, license string, term string, weight double"))
    known = F.broadcast(spark.createDataFrame(sorted(idf.items()), "term string, idf double"))
    key = ["row", "kind", "line", "counts", "n"]
    term = units(marked).select(*key, F.explode("w").alias("term")).groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf")).join(known, "term", "left")
    tf = F.when(F.col("kind") == HEADER, F.col("tf").cast("double")).otherwise(1 + F.log("tf"))
    term = term.withColumn("x", tf * F.coalesce("idf", F.lit(unseen)))
    # a unit's norm, and of its terms those that the templates have
    whole = term.groupBy(*key).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"),
                                   F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("term", "x"))).alias("terms"))
    cosine = (whole.select(*key, "norm", F.inline("terms")).join(terms, ["kind", "term"])
              .groupBy(*key, "license").agg(F.round(F.sum(F.col("x") * F.col("weight")) / F.first("norm"), 6).alias("cosine")))
    best = cosine.groupBy(*key).agg(F.min(F.struct((-F.col("cosine")).alias("minus"), "license")).alias("b"))
    best = best.select(*key, F.col("b.license").alias("license"), (-F.col("b.minus")).alias("cosine"))
    return best.where(F.col("cosine") >= F.when(F.col("kind") == HEADER, F.lit(least)).otherwise(F.lit(least_file)))


def scan(files: DataFrame, *, least: float = 0.6, least_file: float = 0.4, file_share: float = 0.5) -> DataFrame:
    """files: doc_id, path (``/a/b/name``), text.  One row per file row: doc_id, path,
    license, cosine, how (header, file, inherited, none) and from_dir (the ancestor)."""
    speaks_of = F.coalesce(F.col("text").rlike(SPEAKS), F.lit(False))
    marked = stored(files.where(speaks_of).select("doc_id", "path", "text", F.monotonically_increasing_id().alias("row")), "licences")
    found = stored(matches(marked, least, least_file), "licence-units")
    head = F.col("kind") == HEADER
    best = lambda kind: F.min(F.when(kind, F.struct((-F.col("cosine")).alias("minus"), "license")))
    # a line counts once towards the share, whether it matches alone or with its neighbours
    own = found.groupBy("row").agg(best(head).alias("h"), best(~head).alias("f"), F.sum(F.when(head, F.col("n"))).alias("held"))
    own = own.select("row", "held", F.coalesce("h.license", "f.license").alias("own"), (-F.coalesce("h.minus", "f.minus")).alias("cosine"),
                     F.when(F.col("h").isNotNull(), "header").otherwise("file").alias("by"), F.col("f.license").alias("file"))
    directory = F.regexp_replace("path", "/[^/]*$", "")
    rows = marked.select("doc_id", "path", directory.alias("dir"), "row", F.size(words(F.col("text"))).alias("total")).join(own, "row", "left")
    said_by = F.coalesce("file", F.when(F.col("held") >= file_share * F.col("total"), F.col("own")))
    votes = rows.select("dir", said_by.alias("said")).where("said is not null").groupBy("dir", "said").agg(F.count(F.lit(1)).alias("n"))
    speaks = votes.groupBy("dir").agg(F.min(F.struct((-F.col("n")).alias("minus"), "said")).alias("b")).select(
        F.col("dir").alias("above"), F.col("b.said").alias("said"))
    # each distinct directory with the paths above it, nearest last
    dirs = files.select(directory.alias("dir")).distinct()
    parts = F.split("dir", "/")
    ups = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("above"))
    nearest = (ups.join(speaks, "above").groupBy("dir").agg(F.max(F.struct(F.length("above").alias("n"), "above", "said")).alias("b"))
               .select("dir", F.col("b.above").alias("from_dir"), F.col("b.said").alias("said")))
    plain = files.where(~speaks_of).select("doc_id", "path", directory.alias("dir"), F.lit(None).cast("string").alias("own"),
                                           F.lit(None).cast("double").alias("cosine"), F.lit(None).cast("string").alias("by"))
    every = rows.select("doc_id", "path", "dir", "own", "cosine", "by").unionByName(plain).join(nearest, "dir", "left")
    mine = F.col("own").isNotNull()
    return every.select(
        "doc_id", "path", F.coalesce("own", "said").alias("license"), "cosine",
        F.when(mine, F.col("by")).when(F.col("said").isNotNull(), "inherited").otherwise("none").alias("how"),
        F.when(~mine, F.col("from_dir")).alias("from_dir"))


def as_files(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """Documents laid out as files (see above)."""
    key = F.col(id_col).cast("long")
    lang = F.concat(F.lit("/"), F.coalesce(lang_col, F.lit("_")))
    leaf = F.concat(F.lit("/"), F.coalesce(F.floor(key / 64).cast("string"), F.lit("_")))
    nothing = F.lit("")
    return docs.select(key.alias("doc_id"), F.col(text_col).alias("text"), F.concat(
        F.lit("/"), F.coalesce(source_col, F.lit("_")), F.when(key % 1024 == 0, nothing).otherwise(lang), F.when(key % 64 == 0, nothing).otherwise(leaf),
        F.lit("/"), F.coalesce(key.cast("string"), F.lit("_"))).alias("path"))


def _sql() -> str:
    given, idf, unseen = template_terms()
    quoted = lambda rows: ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v!r}::double" for v in r) + ")" for r in rows)
    speaks = SPEAKS.replace("'", "''")
    return f"""
with terms(kind, license, term, weight) as (values {quoted(given)}),
known(term, idf) as (values {quoted(sorted(idf.items()))}),
files as materialized (
  select row_number() over () as row, doc_id, text, coalesce(regexp_matches(text, '{speaks}'), false) as marked,
         '/' || coalesce(source, '_') || case when doc_id % 1024 = 0 then '' else '/' || coalesce(lang, '_') end
         || case when doc_id % 64 = 0 then '' else '/' || coalesce(cast(doc_id // 64 as varchar), '_') end as dir,
         coalesce(cast(doc_id as varchar), '_') as name
  from documents),
lines as (select row, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') as ls from files where marked),
spot as (select row, ls, unnest(range(1, len(ls) + 1)) as i from lines),
units as (
  select row, 'header' as kind, i, 1 as counts, ls[i] as t from spot where regexp_matches(ls[i], '{speaks}')
  union all select row, 'header', i, 0, array_to_string(ls[greatest(i - 1, 1):i + 1], ' ') from spot where regexp_matches(ls[i], '{speaks}')
  union all select row, 'file', 0, 1, text from files where marked),
bag as materialized (
  select row, kind, i, counts, w, count(*) as tf from (
    select row, kind, i, counts, unnest(regexp_extract_all(lower(t), '[a-z0-9]+')) as w from units) group by all),
vec as materialized (
  select b.*, case when kind = 'header' then cast(tf as double) else 1 + ln(tf) end * coalesce(k.idf, {unseen!r}::double) as x
  from bag b left join known k on k.term = b.w),
norm as (select row, kind, i, counts, sqrt(sum(x * x)) as norm, case when counts = 1 then sum(tf) else 0 end as n from vec group by row, kind, i, counts),
cosine as (
  select v.row, v.kind, v.i, v.counts, t.license, round(sum(v.x * t.weight) / any_value(n.norm), 6) as cosine, any_value(n.n) as n
  from vec v join terms t on t.kind = v.kind and t.term = v.w
  join norm n on n.row = v.row and n.kind = v.kind and n.i = v.i and n.counts = v.counts group by v.row, v.kind, v.i, v.counts, t.license),
best as (
  select * from (select *, row_number() over (partition by row, kind, i, counts order by cosine desc, license) as r from cosine)
  where r = 1 and cosine >= case when kind = 'header' then 0.6 else 0.4 end),
top as (
  select row, kind, license, cosine, row_number() over (partition by row, kind order by cosine desc, license) as r from best),
held as (select row, sum(n) as held from best where kind = 'header' group by row),
total as (select row, sum(tf) as total from bag where kind = 'file' group by row),
own as (
  select f.row, f.dir, coalesce(h.license, t.license) as own, coalesce(h.cosine, t.cosine) as cosine, case when h.row is not null then 'header' else 'file' end as how,
         coalesce(t.license, case when held >= 0.5 * total then h.license end) as speaks
  from files f left join top h on h.row = f.row and h.kind = 'header' and h.r = 1 left join top t on t.row = f.row and t.kind = 'file' and t.r = 1
  left join held on held.row = f.row left join total on total.row = f.row
  where h.row is not null or t.row is not null),
said as (
  select dir, license from (select dir, speaks as license, row_number() over (partition by dir order by count(*) desc, speaks) as r
                            from own where speaks is not null group by dir, speaks) where r = 1),
nearest as (
  select d.dir, arg_max(s.dir, length(s.dir)) as from_dir, arg_max(s.license, length(s.dir)) as license
  from (select distinct dir from files) d join said s on d.dir = s.dir or starts_with(d.dir, s.dir || '/') group by d.dir)
select f.doc_id, f.dir || '/' || f.name as path, coalesce(o.own, n.license) as license, o.cosine,
       case when o.own is not null then o.how when n.license is not null then 'inherited' else 'none' end as how,
       case when o.own is null then n.from_dir end as from_dir
from files f left join own o on o.row = f.row left join nearest n on n.dir = f.dir
"""


SQL = _sql()
