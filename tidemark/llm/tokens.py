"""Token ids of whole texts, through a table of token groups.

The vocabulary's rules cut a text into groups that are encoded each for itself: a contraction, a run of letters, a digit, or a run
of other marks; white space parts them and is dropped. A text of common letters and marks (Latin, Greek, Cyrillic, general
punctuation; composed, lower case letter by letter) is cut and hashed as numpy arrays, and a group's ids are looked up by its 64-bit
hash; the library encodes each group the first time. Any other text, and one that might hold a special token, goes through the
library whole. Groups of up to LONG letters are hashed as sums of powers, longer ones by BLAKE2 (see textnum); in a full table of a
million groups two share a hash with a probability of about 3e-8.

`split` must be left off for vocabularies with other rules; then the library encodes every text whole."""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from tidemark.llm.textnum import LONG, _up_to, digest, mix, series

VOCABULARY = "word_bpe_49k.json"
#: Groups that a worker remembers at most (about 50 bytes each), and at first; a full table starts anew.
REMEMBERED, AT_FIRST = 1 << 20, 1 << 15
#: Code points per pass.
PASS = 1 << 18
TOP = 0x2100
SPACE, LETTER, DIGIT, MARK, OTHER = range(5)
_encoders: dict = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str | None = None, split: bool = True) -> Encoder:
    """This process's encoder, with what it remembers."""
    if (path, split) not in _encoders:
        _encoders[path, split] = Encoder(path, split)
    return _encoders[path, split]


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of the code points below TOP; OTHER is what the array path leaves to the library."""
    kind, low = np.full(TOP + 1, OTHER, np.uint8), np.arange(TOP + 1, dtype=np.uint32)
    for i in [*range(0x300), *range(0x370, 0x530), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x20C0)]:
        c = chr(i)
        group, small = unicodedata.category(c), c.lower()
        if c in " \t\n\r":
            kind[i] = SPACE
        elif c.isspace() or group[0] in "CMZ" or len(small) != 1 or unicodedata.normalize("NFC", c) != c or ord(small) >= TOP:
            continue
        else:
            kind[i], low[i] = {"L": LETTER, "N": DIGIT}.get(group[0], MARK), ord(small)
    return kind, low


class Encoder:
    def __init__(self, path: str | None = None, split: bool = True, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(path or vocabulary_path())
        self.split, self.most, self.at_first = split, remembered, min(AT_FIRST, remembered)
        if split:
            self.ends = np.zeros(self.inner.get_vocab_size(), bool)
            self.ends[[i for t, i in self.inner.get_vocab().items() if t.endswith("</w>")]] = True
            self.kind, self.low = _classes()
            self.code = series(TOP + 1, 41)
            self._forget()

    def _forget(self) -> None:
        self.room = self.n = self.used = 0
        self.hash, self.at, self.length, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)
        self._widen(self.at_first)

    def _widen(self, room: int) -> None:
        """Makes room for so many groups."""
        self.room, self.size = room, 1 << (2 * room - 1).bit_length()
        self.keys, self.place = np.zeros(self.size, np.uint64), np.zeros(self.size, np.int32)
        self.hash, self.at, self.length = (np.concatenate([x, np.zeros(room - len(x), x.dtype)]) for x in (self.hash, self.at, self.length))
        self._enter(self.hash[: self.n], np.arange(self.n, dtype=np.int32))

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.inner.encode_batch_fast(texts, add_special_tokens=False)]

    def _groups(self, groups: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the groups in a row, and how many each has."""
        ids = np.array(self.inner.encode_batch_fast([" ".join(groups)], add_special_tokens=False)[0].ids, np.uint32)
        end = np.flatnonzero(self.ends[ids]) + 1
        if len(end) != len(groups):
            each = [np.frombuffer(x, "<u4") for x in self._whole(groups)]
            return np.concatenate(each), np.array([len(x) for x in each])
        return ids, np.diff(end, prepend=0)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash in the table, or -1."""
        slot = (h & np.uint64(self.size - 1)).astype(np.int64)
        key = self.keys[slot]
        out = np.where(key == h, self.place[slot], -1)
        left = np.flatnonzero((key != h) & (key != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (self.size - 1)
            key = self.keys[slot[left]]
            hit = key == h[left]
            out[left[hit]] = self.place[slot[left[hit]]]
            left = left[~hit & (key != 0)]
        return out

    def _add(self, h: np.ndarray, ids: np.ndarray, length: np.ndarray) -> None:
        """Puts different, unknown hashes into the table."""
        n, end = len(h), self.used + len(ids)
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(end - len(self.flat), len(self.flat)), np.uint32)])
        self.flat[self.used : end] = ids
        own = slice(self.n, self.n + n)
        self.hash[own], self.at[own], self.length[own] = h, self.used + np.cumsum(length) - length, length
        self._enter(h, np.arange(self.n, self.n + n, dtype=np.int32))
        self.n, self.used = self.n + n, end

    def _enter(self, h: np.ndarray, index: np.ndarray) -> None:
        n = len(h)
        slot = (h & np.uint64(self.size - 1)).astype(np.int64)
        todo = np.arange(n)
        while len(todo):
            free = todo[self.keys[slot[todo]] == 0]
            first = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[first]], self.place[slot[first]] = h[first], index[first]
            todo = todo[self.keys[slot[todo]] != h[todo]]
            slot[todo] = (slot[todo] + 1) & (self.size - 1)

    def _arrays(self, cp: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Ids of texts laid end to end, each closed by a line feed. cp: lower-case code points; ends: places of these line feeds."""
        kind = self.kind[cp]
        cut = np.empty(len(cp), bool)
        cut[0] = True
        np.not_equal(kind[1:], kind[:-1], out=cut[1:])
        cut |= kind == DIGIT
        tick = np.flatnonzero(cp == ord("'"))
        if len(tick):
            tick = tick[cut[tick]]
            a, b = cp[np.minimum(tick + 1, len(cp) - 1)], cp[np.minimum(tick + 2, len(cp) - 1)]
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
            for at, n in ((tick[one], 2), (tick[two], 3)):
                for k in range(1, n):
                    cut[at + k] = False
                cut[at + n] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(cp))
        ink = kind[start] != SPACE
        start, end = start[ink], end[ink]
        if not len(start):
            return [b""] * len(ends)
        up, down = _up_to(len(cp) + 1)
        total = np.empty(len(cp) + 1, np.uint64)
        total[0] = 0
        np.cumsum(self.code[cp] * up[: len(cp)], out=total[1:])
        h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)) | np.uint64(1)
        for k in np.flatnonzero(end - start > LONG).tolist():
            h[k] = digest(cp[start[k] : end[k]].tobytes()) | 1
        found = self._find(h)
        lost = np.flatnonzero(found < 0)
        if len(lost):
            new, first, back = np.unique(h[lost], return_index=True, return_inverse=True)
            if self.n + len(new) > max(self.room, self.most):
                self._forget()
                lost = np.arange(len(h))
                new, first, back = np.unique(h, return_index=True, return_inverse=True)
            if self.n + len(new) > self.room:
                self._widen(max(2 * self.room, 2 * (self.n + len(new))))
            at = lost[first]
            groups = [cp[s:e].tobytes().decode("utf-32-le") for s, e in zip(start[at].tolist(), end[at].tolist(), strict=True)]
            base = self.n
            for k in range(0, len(groups), 20_000):
                self._add(new[k : k + 20_000], *self._groups(groups[k : k + 20_000]))
            found[lost] = base + back
        length = self.length[found].astype(np.int64)
        stop = np.cumsum(length)
        ids = self.flat[np.repeat(self.at[found] - (stop - length), length) + np.arange(stop[-1])]
        upto = np.concatenate(([0], stop))[np.searchsorted(start, ends)]
        raw, upto = ids.astype("<u4", copy=False).tobytes(), (4 * upto).tolist()
        return [raw[a:b] for a, b in zip([0, *upto], upto, strict=False)]

    def encode(self, texts) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; a null text is empty."""
        texts = [t or "" for t in texts]
        if not self.split:
            return self._whole(texts)
        out: list[bytes] = [b""] * len(texts)
        held: list[int] = []
        size = 0

        def close():
            raw = "\n".join([*(texts[i] for i in held), ""])
            cp = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), "<u4")
            cp = np.where(cp > TOP, TOP, cp)
            ends = np.cumsum([len(texts[i]) + 1 for i in held]) - 1
            odd = np.add.reduceat(self.kind[cp] == OTHER, np.concatenate(([0], ends[:-1] + 1))) > 0
            odd |= np.array(["<|" in texts[i] for i in held])
            if odd.any():
                fine = [i for i, o in zip(held, odd, strict=True) if not o]
                rare = [i for i, o in zip(held, odd, strict=True) if o]
                for i, ids in zip(rare, self._whole([texts[i] for i in rare]), strict=True):
                    out[i] = ids
                if not fine:
                    return
                keep = np.repeat(~odd, np.diff(np.concatenate(([0], ends + 1))))
                cp, ends = cp[keep], np.cumsum([len(texts[i]) + 1 for i in fine]) - 1
            else:
                fine = held
            for i, ids in zip(fine, self._arrays(self.low[cp], ends), strict=True):
                out[i] = ids

        for i, t in enumerate(texts):
            held.append(i)
            size += len(t) + 1
            if size >= PASS or i == len(texts) - 1:
                close()
                held, size = [], 0
        return out
