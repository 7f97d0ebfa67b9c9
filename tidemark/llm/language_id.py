"""Language ID by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed greedily against each: a phrase is the longest
match from where the last one ended, an unknown character is a phrase of its own. The language needing fewest phrases,
normalised by the text's length and by the logarithm of the automaton's text length, wins; ties go to the first name.

Text is lower-cased, and runs of anything but letters are one blank; every letter of the learned texts is told apart, however many there are. Automata are
hash tables of transitions, so their size grows with the learned text and not with the alphabet. The parse is that of the whole text: for speed, pieces of
PIECE characters are parsed in step as numpy vectors, first each from the root; then each again from the state in which the piece before it really
ends, until both parses are in the same state, and so on until nothing changes.

Learning uses a bounded sample of labelled rows: of each language the DOCS documents with the least hash of doc_id (ties by doc_id; of several texts of one doc_id that with the least hash), their whole texts; with very many languages fewer
of each, so that all have ALL_DOCS at most. Documents of more than LONGEST letters teach nothing where their language has shorter ones, and a document is passed over with which its language would have more
than CHARS letters (or its part of ALL_CHARS), so that automata have bounded size; a language of longer documents only is learned from the first LONGEST letters of its shortest. A text that is null or has no letter is `und` with score 0; so is every text if nothing could be
learned. Rows with a null doc_id and repeated rows get a prediction each, an empty table gives an empty one. doc_id, lang and source are no inputs of a prediction; other columns are ignored."""

from __future__ import annotations

import sys
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.shared import crc_mod, free_name, let_go, table

DOCS, ALL_DOCS, PIECE, BATCH = 24, 4_000, 512, 4_000_000
LONGEST, CHARS, ALL_CHARS = 200_000, 600_000, 8_000_000
#: Numbers (of four bytes) in a plain table of transitions.
TABLE = 8_000_000
BLANK, OTHER, PAD, FIRST = 0, 1, 2, 3
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def char_table(letters: str) -> np.ndarray:
    t = np.zeros(sys.maxunicode + 1, np.int32)
    t[[i for i in range(sys.maxunicode + 1) if chr(i).isalpha()]] = OTHER
    for k, c in enumerate(letters):
        t[ord(c)] = FIRST + k
    return t


def codes(text: str, chars: np.ndarray) -> np.ndarray:
    c = chars[code_points(text.lower())]
    blank = c == BLANK
    blank[1:] &= blank[:-1].copy()
    blank[:1] = False
    return c[~blank]


class Automaton:
    """The suffix automaton of a row of codes. OTHER and codes that aren't there never match, PAD stays.

    With few different codes the transitions are a plain table, a row per state; with many (beyond TABLE numbers) an open hash table from (state, code) to state."""

    def __init__(self, seq: list[int]):
        edges, link, size, out, last = {}, [-1], [0], [[]], 0
        for c in seq:
            cur = len(link)
            link.append(0)
            size.append(size[last] + 1)
            out.append([])
            p = last
            while p >= 0 and (p, c) not in edges:
                edges[p, c] = cur
                out[p].append(c)
                p = link[p]
            if p >= 0:
                q = edges[p, c]
                if size[p] + 1 == size[q]:
                    link[cur] = q
                else:
                    clone = len(link)
                    link.append(link[q])
                    size.append(size[p] + 1)
                    out.append(list(out[q]))
                    for d in out[q]:
                        edges[clone, d] = edges[q, d]
                    while p >= 0 and edges.get((p, c)) == q:
                        edges[p, c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        pairs = [(s, c, to) for (s, c), to in edges.items() if c != OTHER]
        e = np.array(pairs, np.int64).reshape(-1, 3)
        known = np.unique(e[:, 1])
        self.width = len(known) + 2
        if len(link) * self.width <= TABLE:
            self.column = np.zeros(max([PAD, *known.tolist()]) + 1, np.int64)  # column 0: no such code
            self.column[known], self.column[PAD] = np.arange(2, self.width), 1
            t = np.full((len(link), self.width), -1, np.int32)
            t[:, 1] = np.arange(len(link))
            t[e[:, 0], self.column[e[:, 1]]] = e[:, 2]
            self.flat, self.root = t.ravel(), np.maximum(t[0], 0)
        else:
            self.flat = None
            self._fill(e)

    def local(self, pieces: np.ndarray) -> np.ndarray:
        """The codes as `read` wants them."""
        if self.flat is None:
            return pieces
        return np.where(pieces < len(self.column), self.column[np.minimum(pieces, len(self.column) - 1)], 0)

    def _fill(self, e: np.ndarray) -> None:
        self.shift = np.uint64(64 - max(4, (2 * len(e)).bit_length()))
        room = 1 << (64 - int(self.shift))
        self.keys, self.to = np.full(room, -1, np.int64), np.full(room, -1, np.int32)
        key = e[:, 0] << 21 | e[:, 1]
        slot, todo = self._slot(key), np.arange(len(e))
        while len(todo):
            free = todo[self.keys[slot[todo]] < 0]
            first = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[first]], self.to[slot[first]] = key[first], e[first, 2]
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = (slot[todo] + 1) & (room - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The states behind these, -1 where there is no transition."""
        key = state.astype(np.int64) << 21 | c
        slot = self._slot(key)
        seen = self.keys[slot]
        to = np.where(seen == key, self.to[slot], -1)
        lost = np.flatnonzero((seen != key) & (seen >= 0))
        while len(lost):
            slot[lost] = (slot[lost] + 1) & (len(self.keys) - 1)
            seen = self.keys[slot[lost]]
            hit = seen == key[lost]
            to[lost[hit]] = self.to[slot[lost[hit]]]
            lost = lost[~hit & (seen >= 0)]
        return to

    def read(self, state: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after one more character of each, and the places at which a phrase ended before it."""
        if self.flat is not None:
            to = self.flat.take(state * self.width + c)
            miss = np.flatnonzero(to < 0)
            to[miss] = self.root[c[miss]]
            return to, miss
        to = self.step(state, c)
        stays = c == PAD
        to[stays] = state[stays]
        miss = np.flatnonzero(to < 0)
        to[miss] = np.maximum(self.step(np.zeros(len(miss), np.int64), c[miss]), 0)
        return to, miss


def phrases(pieces: np.ndarray, first: np.ndarray, a: Automaton) -> np.ndarray:
    """Phrase ends of the texts in the columns of `pieces`, each piece going on where the one before it ends, but for those that are `first` of a text."""
    pieces, width = a.local(pieces), pieces.shape[1]
    state, n = np.zeros(width, np.int64), np.zeros(width, np.int64)
    for c in pieces:
        state, ended = a.read(state, c)
        n[ended] += 1
    came = np.where(first, 0, np.concatenate(([0], state[:-1])))  # state in which a piece is entered
    used = np.zeros(width, np.int64)
    todo = np.flatnonzero(came != used)
    while len(todo):
        # both ways through the piece in step, the one taken before and the right one, until they meet
        old, new, at = used[todo], came[todo], todo
        used[todo] = new
        end = state.copy()
        for c in pieces:
            own = c[at]
            old, one = a.read(old, own)
            new, two = a.read(new, own)
            n[at[one]] -= 1
            n[at[two]] += 1
            apart = np.flatnonzero(old != new)
            if len(apart) < len(at):
                old, new, at = old[apart], new[apart], at[apart]
                if not len(at):
                    break
        end[at] = new
        changed = np.flatnonzero(end != state) + 1
        state = end
        changed = changed[changed < width]
        todo = changed[~first[changed]]
        came[todo] = state[todo - 1]
    return n


class Model:
    def __init__(self, samples: dict[str, list[str]]):
        """samples: texts by language."""
        self.letters = "".join(sorted({c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha()}))
        chars = char_table(self.letters)
        self.names, self.tables, self.logs = [], [], []
        for name in sorted(samples):
            seq = [c for x in samples[name] for c in (*codes(x, chars).tolist(), OTHER)]
            if any(c >= FIRST for c in seq):
                self.names.append(name)
                self.tables.append(Automaton(seq))
                self.logs.append(np.log2(len(seq) + 2))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_chars"}

    def predict(self, texts) -> list[tuple[str, float]]:
        """Language and score of each text."""
        chars = char_table(self.letters) if not hasattr(self, "_chars") else self._chars
        self._chars = chars
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        held, total = [], 0
        for i, text in enumerate(texts):
            c = codes(text, chars) if text else np.zeros(0, np.int32)
            if self.names and (c != BLANK).any():
                held.append((i, c))
                total += len(c)
            if held and (total >= BATCH or i == len(texts) - 1):
                self._parse(held, out)
                held, total = [], 0
        return out

    def _parse(self, held, out) -> None:
        n = [-(-len(c) // PIECE) for _, c in held]
        at = np.cumsum([0, *n])
        pieces = np.full(at[-1] * PIECE, PAD, np.int32)
        for (_, c), a in zip(held, at, strict=False):
            pieces[a * PIECE : a * PIECE + len(c)] = c
        pieces = np.ascontiguousarray(pieces.reshape(-1, PIECE).T).astype(np.int64)
        first = np.zeros(at[-1], bool)
        first[at[:-1]] = True
        length = np.array([len(c) for _, c in held], float)
        cost = np.stack([(np.add.reduceat(phrases(pieces, first, t), at[:-1]) + 1) * log / length for t, log in zip(self.tables, self.logs, strict=True)])
        best = cost.argmin(0)
        sure = 1 / np.exp2(-np.minimum(8 * (cost - cost.min(0)), 60)).sum(0)
        for k, (i, _) in enumerate(held):
            out[i] = (self.names[best[k]], float(sure[k]))


def learned(docs: DataFrame, most: int = DOCS, all_: int = ALL_DOCS) -> Model:
    """docs: doc_id, text, lang; rows without a text, lang or doc_id teach nothing."""
    docs, size = docs.select("doc_id", "text", "lang"), F.greatest(F.length("text"), F.lit(LONGEST))  # one and the same for all that may teach
    ids = docs.where("lang is not null and doc_id is not null").groupBy("doc_id", "lang").agg(F.min(size).alias("size"))
    languages = max(1, ids.select("lang").distinct().count())
    most, chars = max(1, min(most, all_ // languages)), min(CHARS, ALL_CHARS // languages)
    rank = F.row_number().over(W.partitionBy("lang").orderBy("size", F.xxhash64("doc_id"), "doc_id"))
    ids = ids.withColumn("rank", rank).where((F.col("rank") <= most) & ((F.col("size") <= LONGEST) | (F.col("rank") == 1))).select(F.col("doc_id").alias("_d"), F.col("lang").alias("_l"), "rank", F.col("size").alias("_s"))
    some = docs.where("text is not null").join(F.broadcast(ids), (F.col("doc_id") == F.col("_d")) & (F.col("lang") == F.col("_l")) & (size == F.col("_s")))
    some = some.groupBy("lang", "rank").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).withColumn("text", F.substring("text", 1, LONGEST))
    samples: dict[str, list[str]] = defaultdict(list)
    used: dict[str, int] = defaultdict(int)
    for r in some.orderBy("lang", "rank").toLocalIterator():
        if not used[r.lang] or used[r.lang] + len(r.text) <= chars:
            samples[r.lang].append(r.text)
            used[r.lang] += len(r.text)
    return Model(samples)


def languages(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred and score added; columns of these names are replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        let_go()
        return pd.DataFrame(sent.value.predict(text.tolist()), columns=["lang_pred", "score"])

    both = free_name(docs, "_p")
    return docs.withColumn(both, predict("text")).withColumns({c: F.col(both)[c] for c in ("lang_pred", "score")}).drop(both)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learned(docs.where(crc_mod("doc_id", 3) != 1))
    return languages(docs.select("doc_id", "text"), model).select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
