"""The whole pipeline on a small corpus against plain Python, stage by stage."""

import random
import re

import corpus_pipeline
from ledgerlake.llm import sentencepieces
from ledgerlake.llm.common import stored

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def _near(docs):
    """Ids that stay: the smallest of each component of texts alike in 5-word shingles."""
    sets = {}
    for i, t in docs:
        w = _lower(t).split()
        sets[i] = {tuple(w[k:k + min(5, len(w))]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((root[a], root[b]))
                root = {k: lo if v == hi else v for k, v in root.items()}
    return {i for i in ids if root[i] == i}


def _cut(docs):
    """Texts without the characters whose bytes are all covered by an earlier document's strings."""
    first = {}
    raw = {i: (t or "").encode() for i, t in docs}
    for i in sorted(raw):
        for p in range(len(raw[i]) - 49):
            first.setdefault(raw[i][p:p + 50], i)
    out = {}
    for i, b in raw.items():
        gone = [False] * len(b)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone[p:p + 50] = [True] * 50
        text, at = [], 0
        for c in b.decode():
            n = len(c.encode())
            if not all(gone[at:at + n]):
                text.append(c)
            at += n
        out[i] = "".join(text)
    return out


def _clean(text, benchmark):
    words = WORD.findall(_lower(text))
    for item in benchmark:
        w = WORD.findall(_lower(item))
        n = min(10, len(w))
        windows = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if n else set()
        if any(tuple(words[k:k + n]) in windows for k in range(len(words) - n + 1)):
            return False
    return True


def _corpus():
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abdeghiklmnoprstuvé") for _ in range(r.randrange(3, 9))) for _ in range(900)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n)) + "."
    bench = [prose(25) for _ in range(6)]
    passages = [prose(14) for _ in range(4)]
    insults = ["idiot", "moron", "scum", "stupid", "loser"]
    rows, labels = [], []
    for i in range(160):
        kind, text = i % 16, prose(r.randrange(20, 120))
        if kind == 3 and i > 16:
            text = rows[r.randrange(len(rows))][1]                                   # an exact copy
        elif kind == 5 and i > 16:
            w = rows[i - 5][1].split()
            w[r.randrange(len(w))] = "changed"
            text = " ".join(w)                                                       # a near copy
        elif kind in (7, 8):
            text += " " + r.choice(passages) + " " + prose(20)                       # a shared passage
        elif kind == 10:
            text += " " + r.choice(bench) + " " + prose(5)                           # a benchmark item
        elif kind in (12, 13):
            w = text.split()
            for _ in range(8):
                w.insert(r.randrange(len(w)), r.choice(insults))
            text = "you " + " you ".join(w)                                          # toxic
        rows.append((i, text))
        if i % 2:
            labels.append((i, 1, int(kind in (12, 13))))
    return rows + [(200, None), (201, "")], labels, bench


def test_run_equals_brute_force(spark, tmp_path):
    rows, labels, bench = _corpus()
    sf = str(tmp_path)
    spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint") \
        .repartition(4).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in stored(corpus_pipeline.toxic_documents(spark, docs, sf), "t").collect()}
    toxic = {i for i, _ in rows if i < 160 and i % 16 in (12, 13)}
    assert kept == {i for i, _ in rows} - toxic  # the planted ones go, all others stay
    one = [(i, t) for i, t in rows if i in kept]
    stay = _near(one)
    assert len(stay) < len(one)
    cut = _cut([(i, t) for i, t in one if i in stay])
    assert any(cut[i] != (t or "") for i, t in one if i in stay)
    want = {i: t for i, t in cut.items() if _clean(t, bench)}
    assert len(want) < len(cut)

    out = corpus_pipeline.run(spark, sf)
    assert all(r.round_trip for r in out.select("round_trip").collect())
    got = {r.doc_id: r.text for r in sentencepieces.decode_documents(out).collect()}
    assert got == want


def test_stages_are_named_in_their_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_text", "decontamination", "tokens"]
