"""Edge rows for every operator and stage: nulls, empty and long texts, ties and
repeated rows, empty tables, extra columns whose names clash with internal ones."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import decontaminate, extract, licenses, lm, minhash, repeats, sentencepieces, sharding, topk, toxicity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, grp int, bucket string, id string, score double, kept string"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
BASE = " ".join(f"word{i}" for i in range(60))
TEXTS = [(1, BASE), (2, BASE), (3, BASE + " tail"), (4, None), (5, ""), (6, "   \n\t"), (7, "one"), (7, "one"), (8, LONG),
         (9, LONG + " end"), (None, BASE), (10, "idiot moron you idiot scum"), (11, "Released under the MIT License."),
         (12, "ünïcödé 日本語 😀 " * 9), (13, "🙂" * 400)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i != 3 else None, "src0" if i != 2 else None, None, 5, 5, "b", "x", 0.5, "k") for i, t in TEXTS]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, int(i == 10)) for i in range(1, 13)] + [(None, 1, 1), (2, None, None)],
                                 "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(10, 30))), (2, None), (3, ""), (4, "one"), (None, "w5x5")],
                                 "item_id bigint, text string")


def test_near_duplicates(docs):
    r = [(x.doc_id, x.n_shingles, x.component_id, x.kept) for x in minhash.near_duplicates(docs, words=4).collect()]
    by = {x[0]: x for x in r}
    assert len(r) == len(TEXTS)
    assert [by[i][2] for i in (1, 2, 3)] == [1, 1, 1] and by[9][2] == 8
    assert all(by[i][1:] == (0, i, True) for i in (4, 5, 6))
    assert by[7][1:] == (1, 7, True) and by[None][2:] == (None, True)


def test_repeats(docs):
    r = {x.row: x for x in repeats.cut_repeats(docs).where("row is not null").collect()}
    assert r[2].kept == b"" and r[2].starts == [0] and bytes(r[1].kept) == BASE.encode()
    assert bytes(r[3].kept) == b" tail"[-5:] and r[4].n_bytes == r[5].n_bytes == 0
    assert r[9].n_bytes - len(r[9].kept) == len(LONG.encode())
    assert bytes(r[13].kept) == ("🙂" * 400).encode()  # repeats within a text stay


def test_repeats_keep_columns_and_characters(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "d"))
    out = repeats.remove_repeats(spark.read.parquet(str(tmp_path / "d")))
    assert out.columns == docs.columns and out.count() == len(TEXTS)


def test_sharding(docs):
    r = sharding.shard_documents(docs).collect()
    assert len(r) == len(TEXTS)
    for x in r:
        assert x.grown_shard in (x.shard, 24) and 0 <= x.shard < 24
    by = {}
    for x in r:
        by.setdefault(x.shard, []).append(x.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    x = next(x for x in r if x.doc_id == 4)
    assert (x.size, x.text_crc32) == (8, 0)
    x = next(x for x in r if x.doc_id == 12)
    assert x.text_crc32 == zlib.crc32(TEXTS[13][1].encode())


def test_sharding_is_near_its_weights(spark):
    leaves = [(0, 0, 0, 3.0), (0, 0, 1, 1.0), (1, 1, 2, 4.0), (1, 1, 3, 0.0)]
    n = {r["shard"]: r["count"] for r in sharding.assign(spark.range(20_000), "id", leaves).groupBy("shard").count().collect()}
    assert set(n) == {0, 1, 2}
    assert abs(n[0] / 20_000 - 3 / 8) < 0.02 and abs(n[2] / 20_000 - 1 / 2) < 0.02


def test_top_k(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.5]), (20, None), (40, [1.0, None]), (60, [nan, 1.0]), (80, [float("inf"), 1.0]), (1, [1.0, 0.5]),
            (2, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [-1.0]), (4, []), (None, [1.0, 1.0]), (5, [0.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("grp", F.lit("x")).withColumn("ids", F.lit(1))
    r = [tuple(x) for x in topk.top_k(v, v.where("vec_id % 20 = 0"), k=4).orderBy("rank").collect()]
    top = 64 * 64 + 32 * 32
    assert r == [(0, 1, 1, top), (0, 2, 2, top), (0, 3, 2, top), (0, 4, 4, 0)]


def test_contamination(docs, bench):
    r = {x.doc_id: x for x in decontaminate.digest(decontaminate.contamination(docs, bench)).collect()}
    assert (r[1].n_words, r[1].n_hit, r[1].n_items, r[1].contaminated) == (60, 20, 1, True)
    assert r[7].n_hit == 1 and r[4].n_words == 0 and not r[4].contaminated
    assert r[8].contaminated and r[8].n_items == 0  # the item has no id
    one = decontaminate.digest(decontaminate.contamination(docs, bench)).collect()
    many = decontaminate.digest(decontaminate.contamination(docs, bench, slice_bytes=40)).collect()
    key = lambda x: str(tuple(x))
    assert sorted(one, key=key) == sorted(many, key=key)


def test_remove_spans_and_documents(docs, bench):
    r = {x.doc_id: x.text for x in decontaminate.remove_spans(docs, bench).collect()}
    assert r[1] == " ".join(f"word{i}" for i in range(10)) + "   " + " ".join(f"word{i}" for i in range(30, 60))
    left = decontaminate.remove_documents(docs, bench)
    assert left.columns == docs.columns and {x.doc_id for x in left.collect()} == {4, 5, 6, 10, 11, 12, 13}


def test_toxicity(docs, labels):
    r = {x.doc_id: x for x in toxicity.score_documents(docs, labels).collect()}
    assert r[10].predicted == 1 and r[1].predicted == 0 and r[4].score == r[5].score
    assert toxicity.reject(docs, labels).count() == len(TEXTS) - 1


def test_toxicity_where_a_third_is_toxic(spark):
    rows = [(i, f"note {i} about {'zorblax' if i % 3 == 0 else 'gardens'} and item{i % 7}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id bigint, toxic int")
    assert {(x.doc_id % 3 == 0, x.predicted) for x in toxicity.score_documents(docs, labels).collect()} == {(True, 1), (False, 0)}


def test_toxicity_of_texts_with_a_common_header(spark):
    head = "notice from the desk of the town forum"
    rows = [(i, f"{head} {'zorblax' if i % 5 == 0 else 'gardens'} item{i}") for i in range(400)]
    rows += [(i + 400, t) for i, t in rows[:50]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0 and i < 400)) for i, _ in rows], "doc_id bigint, toxic int")
    got = [{x.doc_id: x.score for x in toxicity.score_documents(d, labels).collect()} for d in (docs.coalesce(1), docs.repartition(7, "text"))]
    assert got[0] == got[1] and {i for i, s in got[0].items() if s >= 0.5} == {i for i, t in rows if "zorblax" in t}


def test_toxicity_is_fitted_without_mined_voters(spark):
    rows = [(i, f"you idiot {i}" if i % 2 else f"fine {i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, toxic int")
    m = toxicity.fit(docs, labels)
    assert m.bias != -2.0 and m.weights[len(toxicity.PATTERNS) + m.names.index(b"=idiot")] not in (0.0, 4.0)
    assert m.weights[len(toxicity.PATTERNS) + m.names.index(b"=vermin")] == 4.0


def test_lm(docs):
    r = {x.doc_id: x for x in lm.score_documents(docs).collect()}
    assert r[4].n_tokens == 1 and r[4].score == r[5].score == r[6].score and r[7].n_tokens == 2
    assert all(x.score < 0 and x.base_score < 0 for x in r.values())


def test_sentencepieces(docs):
    coded = sentencepieces.encode_documents(docs)
    r = coded.collect()
    assert len(r) == len(TEXTS) and all(x.round_trip for x in r)
    assert next(x for x in r if x.doc_id == 4).ids == []
    back = {x.doc_id: x.text for x in sentencepieces.decode_documents(coded).collect()}
    assert back[12] == TEXTS[13][1] and back[4] == ""


def test_licenses(docs):
    r = {x.doc_id: x for x in licenses.scan(licenses.as_files(docs)).collect()}
    assert (r[11].license, r[11].how) == ("MIT", "header")
    assert (r[1].license, r[1].how, r[1].from_dir) == ("MIT", "inherited", "/src0/en/0")
    assert r[2].how == "none" and len(r) == len({i for i, _ in TEXTS})


def test_pages(spark):
    page = ('<html><head><title>t</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/x">x</a></ul></nav>'
            "<article><h1>Head &amp; line</h1><p>One <b>two</b>\n three.<p>Four&#33; fi<i>ve</i> six.</article><footer>&copy; f</footer>")
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "plain &lt; text"), (5, "u", page), (5, "u", page), (None, "u", page)] + [
        (i, "u", page.replace("Four", f"Word{i} and more of it")) for i in range(6, 40)]
    r = extract.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))).collect()
    by = {x.page_id: x for x in r}
    assert len(r) == len(rows)
    assert by[1].text == "Head & line\nOne two three.\nFour! five six." and by[1].n_chars == len(by[1].text)
    assert by[2].text == by[3].text == ""


def test_empty_tables(spark, docs, labels, bench):
    none = docs.limit(0)
    assert minhash.near_duplicates(none).count() == 0
    assert repeats.cut_repeats(none).count() == 0
    assert sharding.shard_documents(none).count() == 0
    assert decontaminate.contamination(none, bench).count() == 0
    assert all(not x.contaminated for x in decontaminate.digest(decontaminate.contamination(docs, bench.limit(0))).collect())
    assert toxicity.score_documents(docs, labels.limit(0)).count() == len(TEXTS)
    assert toxicity.score_documents(none, labels).count() == 0
    assert lm.score_documents(none).count() == 0
    assert sentencepieces.encode_documents(none).count() == 0
    assert licenses.scan(licenses.as_files(none)).count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert extract.main_text(pages).count() == 0
    v = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.top_k(v, v).count() == 0


def test_pipeline_stages(spark, docs, labels, bench, tmp_path):
    sf = str(tmp_path)
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        df.write.parquet(f"{sf}/{name}.parquet")
    r = {x.doc_id for x in corpus_pipeline.run(spark, sf).collect()}
    # 10 is toxic; 1, 2, 3 and the long ones are contaminated or copies; 7 holds "one";
    # the copy without an id stays as a row, its text is cut out
    assert r == {None, 4, 5, 6, 11, 12, 13}
    kept = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, kept, sf).columns == docs.columns, name


def test_near_duplicates_of_ids_with_several_texts(spark):
    """Every link of every text of an id counts; repeated rows stay once in the pipeline."""
    b, c = " ".join(f"b{i}" for i in range(40)), " ".join(f"c{i}" for i in range(40))
    rows = [(1, b), (2, b), (2, c), (3, c + " x"), (7, "alone here with five words"), (7, "alone here with five words"), (8, b + " y"), (9, "quite another text than these"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((x.doc_id, x.component_id, x.kept) for x in minhash.near_duplicates(docs, words=4).collect())
    assert got == [(1, 1, True), (2, 1, False), (2, 1, False), (3, 1, False), (7, 7, True), (7, 7, True), (8, 1, False), (9, 9, True), (9, 9, True)]
    left = sorted((r.doc_id, r.text or "") for r in minhash.keep_one(docs).collect())
    assert left == [(1, b), (7, "alone here with five words"), (9, ""), (9, "quite another text than these")]
