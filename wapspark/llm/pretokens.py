"""Pre-tokens of byte-level BPE vocabularies, whole chunks at a time.

``boundaries`` cuts texts as the public pattern does (contractions; an
optional space and a run of letters, of numbers, or of other characters; white
space) with array operations over code points. Characters whose class is not
the same in old and new Unicode tables, or that libraries class differently,
mark their text, and the caller hands that text to the library itself.

``PretokenCache`` holds the ids of the distinct pre-tokens seen by a worker in
bounded memory: a full cache is emptied and fills again, which changes the
speed and never a result.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np

from wapspark.llm import words as W

OTHER, LETTER, NUMBER, SPACE, UNSURE = range(5)
# Characters of the Unicode property White_Space (fixed values).
_WHITE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028,
          0x2029, 0x202F, 0x205F, 0x3000]
# Separators that only some libraries count as white space.
_UNSURE = [0x1C, 0x1D, 0x1E, 0x1F, 0x180E]

_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Class of every code point; built once a process from the Unicode tables."""
    if not _classes:
        old, new = unicodedata.ucd_3_2_0.category, unicodedata.category
        kind = {"L": LETTER, "N": NUMBER}
        table = np.full(0x110000, UNSURE, np.uint8)
        for i in range(0x110000):
            c = chr(i)
            a, b = old(c), new(c)
            if a[0] == b[0] and a != "Cn":
                table[i] = kind.get(a[0], OTHER)
        table[_WHITE] = SPACE
        table[_UNSURE] = UNSURE
        _classes.append(table)
    return _classes[0]


@dataclass
class Pretokens:
    start: np.ndarray    # first byte of each pre-token
    end: np.ndarray      # byte after its last
    per_row: np.ndarray  # rows + 1: where each row's pre-tokens begin
    unsure: np.ndarray   # rows to hand to the library


def valid_chunk(chunk: W.Chunk) -> W.Chunk:
    """The chunk with invalid UTF-8 read as U+FFFD."""
    try:
        chunk.data.tobytes().decode("utf-8")
        return chunk
    except UnicodeDecodeError:
        texts = [row_bytes(chunk, r).decode("utf-8", "replace").encode("utf-8")
                 for r in range(chunk.rows)]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        return W.Chunk(chunk.first, chunk.rows, np.frombuffer(b"".join(texts), np.uint8), offsets)


def row_bytes(chunk: W.Chunk, row: int) -> bytes:
    return chunk.data[chunk.offsets[row]:chunk.offsets[row + 1]].tobytes()


def boundaries(chunk: W.Chunk) -> Pretokens:
    """Pre-tokens of a chunk of valid UTF-8."""
    lead = np.flatnonzero((chunk.data & 0xC0) != 0x80)
    n = len(lead)
    rows_at = np.searchsorted(lead, chunk.offsets)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Pretokens(none, none, np.zeros(chunk.rows + 1, np.int64), np.zeros(chunk.rows, bool))
    text = np.frombuffer(chunk.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    cls = classes()[text]
    edge = np.zeros(n + 1, bool)
    edge[rows_at] = True
    start = edge[:n].copy()
    start[1:] |= cls[1:] != cls[:-1]
    # The last character of white space before something else in the row: a
    # plain space joins what follows, any other stands alone.
    last = np.flatnonzero((cls[:-1] == SPACE) & (cls[1:] != SPACE) & ~edge[1:n])
    start[last] = True
    joined = last[text[last] == 0x20]
    start[joined + 1] = False
    # A lone apostrophe that begins a pre-token takes s, t, re, ve, m, ll, d.
    quote = np.flatnonzero((text[:-1] == 0x27) & start[:-1] & ~edge[1:n])
    if len(quote):
        nxt = text[quote + 1]
        after = np.append(text, 0)[quote + 2]
        inside = ~edge[np.minimum(quote + 2, n)]
        pair = (((nxt == ord("r")) | (nxt == ord("v"))) & (after == ord("e"))
                | (nxt == ord("l")) & (after == ord("l"))) & inside
        single = np.isin(nxt, [ord(c) for c in "stmd"])
        taken = single | pair
        start[quote[taken] + 1] = False
        stop = quote[taken] + np.where(single[taken], 2, 3)
        start[stop[stop < n]] = True
    at = np.flatnonzero(start)
    first = lead[at]
    end = np.append(first[1:], len(chunk.data))
    unsure = np.zeros(chunk.rows, bool)
    odd = np.flatnonzero(cls == UNSURE)
    unsure[np.searchsorted(rows_at, odd, side="right") - 1] = True
    return Pretokens(first, end, np.searchsorted(at, rows_at), unsure)


class PretokenCache:
    """Ids of pre-tokens by hash; ``encode`` gives the id lists of new ones."""

    def __init__(self, encode, limit: int = 1 << 20):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.hash = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)  # of each slot, and the end
        self.ids = np.zeros(0, np.uint32)

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hash, hashes)
        found = np.full(len(hashes), -1, np.int64)
        inside = at < len(self.hash)
        hit = np.flatnonzero(inside)[self.hash[at[inside]] == hashes[inside]]
        found[hit] = self.slot[at[hit]]
        return found

    def lookup(self, chunk: W.Chunk, pre: Pretokens) -> np.ndarray:
        """A slot for every pre-token of the chunk."""
        unique, where, inverse = np.unique(W.span_hashes(chunk, pre.start, pre.end),
                                           return_index=True, return_inverse=True)
        if len(self.hash) + len(unique) > self.limit:
            self._clear()
        slots = self._slots(unique)
        new = np.flatnonzero(slots < 0)
        if len(new):
            raw = chunk.data.tobytes()
            s, e = pre.start[where[new]].tolist(), pre.end[where[new]].tolist()
            lists = self.encode([raw[a:b] for a, b in zip(s, e)])
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            slots[new] = len(self.first) - 1 + np.arange(len(new))
            self.ids = np.concatenate((self.ids, np.fromiter(
                (i for x in lists for i in x), np.uint32, int(sizes.sum()))))
            self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(sizes)))
            both = np.concatenate((self.hash, unique[new]))
            order = np.argsort(both, kind="stable")
            self.hash = both[order]
            self.slot = np.concatenate((self.slot, slots[new]))[order]
        return slots[inverse]

    def row_ids(self, chunk: W.Chunk, encode_text, whole=None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunk's texts one after another, and the rows' bounds.
        Rows marked in ``whole`` go to ``encode_text`` as those do whose
        pre-tokens are unsure."""
        pre = boundaries(chunk)
        if whole is not None:
            pre.unsure |= whole
        slots = self.lookup(chunk, pre)
        sizes = self.first[slots + 1] - self.first[slots]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.ids[np.repeat(self.first[slots] - ends[:-1], sizes) + np.arange(ends[-1])]
        bounds = ends[pre.per_row]
        if pre.unsure.any():
            parts = [np.asarray(encode_text(row_bytes(chunk, r).decode("utf-8")), np.uint32)
                     if pre.unsure[r] else ids[bounds[r]:bounds[r + 1]] for r in range(chunk.rows)]
            ids = np.concatenate(parts)
            bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return ids, bounds
