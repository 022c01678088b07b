"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

A text gets a space in front, spaces become the marker U+2581, and the pieces with the
greatest sum of log scores are found.  No piece of a usual model continues after a
marker that follows another character, so a text falls into units (markers and what
follows them) whose best paths are independent; where a model has such a piece, the
whole text is one unit.  The new units of a batch are walked through the trie together,
position by position, in numpy, and kept for the texts that follow.  A character that
no piece covers costs the smallest score less ``PENALTY`` and becomes byte pieces.

Decoding joins pieces, turns markers into spaces, byte pieces into bytes (replacing
what is not UTF-8) and drops the space in front.

The model file is read on the driver; its pieces (32,000 or so, bounded by the model)
are broadcast.  Texts never leave their partition: there is no shuffle.

Defined results: a null or empty text has no pieces and decodes to the empty text; a
text that holds the marker itself decodes to a space there, so it does not round-trip;
equal texts have equal pieces.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
PENALTY = 10.0
UNITS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Trie:
    """A double-array trie over bytes: the child of state s by byte b is base[s] + b + 1
    if check there is s; value is the piece that ends in a state, or -1."""

    def __init__(self, keys: list[bytes], values: list[int]):
        order = sorted(range(len(keys)), key=lambda i: keys[i])
        size = 4 * sum(map(len, keys)) + 4096
        taken = bytearray(size)
        used = np.frombuffer(taken, np.bool_)
        base, check, value = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        taken[:257] = b"\1" * 257
        todo = [(0, 0, len(order), 0)]  # state, keys from..to, depth
        free = look = 257
        while todo:
            state, lo, hi, depth = todo.pop()
            while lo < hi and len(keys[order[lo]]) == depth:
                value[state] = values[order[lo]]
                lo += 1
            children: list[tuple[int, int, int]] = []
            i = lo
            while i < hi:
                b, j = keys[order[i]][depth], i
                while j < hi and keys[order[j]][depth] == b:
                    j += 1
                children.append((b, i, j))
                i = j
            if not children:
                continue
            if len(children) == 1:  # any free place will do
                while taken[free]:
                    free += 1
                at = free - children[0][0] - 1
            else:
                offsets = np.array([c[0] + 1 for c in children])
                look = max(look, free)
                start = look
                while True:
                    places = start + np.flatnonzero(~used[start:start + 512]) - offsets[0]
                    fits = places[~used[places[:, None] + offsets].any(axis=1)]
                    if len(fits):
                        break
                    start += 512
                if start > look + 8 * 512:  # what lies far behind is too dense to look at again
                    look = start - 4 * 512
                at = int(fits[0])
            base[state] = at
            for b, i, j in children:
                taken[at + b + 1] = 1
                check[at + b + 1] = state
                todo.append((at + b + 1, i, j, depth + 1))
        end = int(np.flatnonzero(used)[-1]) + 258  # room for any byte after the last state
        self.base, self.check, self.value = base[:end].copy(), check[:end].copy(), value[:end].copy()


class Pieces:
    """The tables of a model, as plain arrays that can be broadcast."""

    def __init__(self, texts: list[str], scores: list[float], kinds: list[str]):
        """kinds: normal, byte, or other (controls and the unknown piece)."""
        normal = [i for i, k in enumerate(kinds) if k == "normal"]
        self.trie = Trie([texts[i].encode() for i in normal], normal)
        self.scores = np.array(scores, np.float64)
        self.unknown_score = float(self.scores[normal].min()) - PENALTY if normal else -PENALTY
        self.longest = max((len(texts[i].encode()) for i in normal), default=1)
        self.byte_id = np.full(256, kinds.index("unknown") if "unknown" in kinds else 0, np.int32)
        self.out: list[bytes] = [t.replace(MARK, " ").encode() for t in texts]
        for i, k in enumerate(kinds):
            if k == "byte":
                b = int(texts[i][3:5], 16)
                self.byte_id[b] = i
                self.out[i] = bytes([b])
            elif k != "normal":
                self.out[i] = b""
        self.whole = any(re.search(f"[^{MARK}]{MARK}", texts[i]) for i in normal)

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece
        p = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(p.vocab_size())
        kinds = ["byte" if p.is_byte(i) else "unknown" if p.is_unknown(i) else "other" if p.is_control(i) or p.is_unused(i) else "normal" for i in ids]
        return cls([p.id_to_piece(i) for i in ids], [p.get_score(i) for i in ids], kinds)

    def viterbi(self, units: list[bytes]) -> list[bytes]:
        """Best piece ids (as int32 bytes) of each unit; units of one length run together."""
        out: list[bytes] = [b""] * len(units)
        order = sorted(range(len(units)), key=lambda i: len(units[i]))
        i = 0
        while i < len(order):
            n = len(units[order[i]])
            j = i
            most = max(1, (1 << 20) // (n + 1))
            while j < len(order) and len(units[order[j]]) == n and j - i < most:
                j += 1
            part = order[i:j]
            for k, found in zip(part, self._paths(np.frombuffer(b"".join(units[k] for k in part), np.uint8).reshape(len(part), n))):
                out[k] = found
            i = j
        return out

    def _paths(self, raw: np.ndarray) -> list[bytes]:
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        m, n = raw.shape
        best = np.full((m, n + 1), -np.inf)
        best[:, 0] = 0
        back, piece = np.zeros((m, n + 1), np.int32), np.full((m, n + 1), -1, np.int32)
        lead = (raw & 0xC0) != 0x80
        width = np.select([raw < 0x80, raw >= 0xF0, raw >= 0xE0, raw >= 0xC0], [1, 4, 3, 2], 1)
        for s in range(n):
            rows = np.flatnonzero(np.isfinite(best[:, s]) & lead[:, s])
            if not len(rows):
                continue
            state, alive, single = np.zeros(len(rows), np.int64), rows, np.zeros(m, bool)
            for e in range(s, min(n, s + self.longest)):
                to = base[state] + raw[alive, e] + 1
                ok = check[to] == state
                state, alive = to[ok], alive[ok]
                if not len(alive):
                    break
                v = value[state]
                has = v >= 0
                if has.any():
                    r, x = alive[has], best[alive[has], s] + self.scores[v[has]]
                    single[r[width[r, s] == e + 1 - s]] = True
                    up = x > best[r, e + 1]
                    r = r[up]
                    best[r, e + 1], back[r, e + 1], piece[r, e + 1] = x[up], s, v[has][up]
            r = rows[~single[rows]]
            if len(r):
                e = np.minimum(s + width[r, s], n)
                x = best[r, s] + self.unknown_score
                up = x > best[r, e]
                r, e = r[up], e[up]
                best[r, e], back[r, e], piece[r, e] = x[up], s, -1
        # back from the end, all units at once
        at, ids = np.full(m, n), np.full((m, n), -1, np.int32)
        slot = np.full(m, n)
        while (at > 0).any():
            on = np.flatnonzero(at > 0)
            b, p = back[on, at[on]], piece[on, at[on]]
            known = p >= 0
            slot[on[known]] -= 1
            ids[on[known], slot[on[known]]] = p[known]
            for k in on[~known]:
                for byte in raw[k, back[k, at[k]]:at[k]][::-1]:
                    slot[k] -= 1
                    ids[k, slot[k]] = self.byte_id[byte]
            at[on] = b
        return [ids[k, slot[k]:].tobytes() for k in range(m)]

    def decode(self, ids) -> str:
        raw = b"".join([self.out[i] for i in ids])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


class Encoder:
    """Encodes texts, keeping the paths of units it has met (at most ``limit``)."""

    def __init__(self, pieces: Pieces, limit: int = 300_000):
        self.pieces, self.limit = pieces, limit
        # units as they stand, and words by what follows their one marker
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def units(self, text: str) -> tuple[list[str], bool]:
        """Units of a text; True: each without its marker."""
        if not self.pieces.whole and not ("  " in text or MARK in text or text[-1] == " " or text[0] == " "):
            return text.split(" "), True
        marked = MARK + text.replace(" ", MARK)
        return ([marked] if self.pieces.whole else UNITS.findall(marked)), False

    def _learn(self, texts: list) -> None:
        units: set[str] = set()
        words: set[str] = set()
        for t in texts:
            if t:
                found, bare = self.units(t)
                (words if bare else units).update(found)
        if len(self.known) + len(self.words) + len(units) + len(words) > self.limit:
            self.known.clear()
            self.words.clear()
        new, new_words = sorted(units - self.known.keys()), sorted(words - self.words.keys())
        paths = self.pieces.viterbi([u.encode("utf-8", "replace") for u in new] + [(MARK + w).encode("utf-8", "replace") for w in new_words])
        self.known.update(zip(new, paths))
        self.words.update(zip(new_words, paths[len(new):]))

    def encode(self, texts: list, at_once: int = 2000) -> list[np.ndarray]:
        out = []
        for s in range(0, len(texts), at_once):
            self._learn(texts[s:s + at_once])
            for t in texts[s:s + at_once]:
                found, bare = self.units(t) if t else ((), False)
                get = (self.words if bare else self.known).__getitem__
                out.append(np.frombuffer(b"".join(map(get, found)), np.int32))
        return out


def encode_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """One row per document row: doc_id, ids (piece numbers), n_tokens and round_trip
    (decoding the pieces gives the text)."""
    spark = docs.sparkSession
    ship(spark)
    given = spark.sparkContext.broadcast(Pieces.load(model))

    def run(batches):
        encoder, pieces = Encoder(given.value), given.value
        for b in batches:
            for s in range(0, len(b), 1000):
                part = b.iloc[s:s + 1000]
                texts = part["text"].tolist()
                ids = encoder.encode(texts)
                yield pd.DataFrame({"doc_id": part["doc_id"], "ids": ids, "n_tokens": [len(x) for x in ids],
                                    "round_trip": [pieces.decode(x.tolist()) == t for x, t in zip(ids, texts)]})

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return src.mapInPandas(run, "doc_id bigint, ids array<int>, n_tokens bigint, round_trip boolean")


def decode_documents(encoded: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """One row per row: doc_id and the text of its pieces; null pieces give the empty text."""
    spark = encoded.sparkSession
    ship(spark)
    given = spark.sparkContext.broadcast(Pieces.load(model))

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return pd.Series([given.value.decode(() if x is None else x) for x in ids], dtype=object)

    return encoded.select(F.col(id_col).alias("doc_id"), text(ids_col).alias("text"))
