"""Byte-level BPE encoding and decoding (operator 5).

The merges (byte strings with ranks) are compiled into a transducer over
bytes, determinised as it is used. Two tokens may stand next to each other
exactly if BPE keeps them so, and the BPE of a text's prefix is the BPE of a
shorter prefix plus its only fitting last token. A state therefore holds the
longest suffix read that can still grow into a token and, for every place in
that suffix where a later token may begin, the tokens of the prefix up to
there that are not out yet. Tokens on which all those places agree are emitted;
the rest waits, for no longer than that suffix lasts. The end of a pre-token
flushes what waits.

Decoding turns ids into bytes and a small state machine, which keeps an
unfinished UTF-8 character back, turns pieces of bytes into text.

Defined results: a null or empty text has no ids and decodes to no bytes; a
null id column value is carried through; repeated rows are encoded one by one;
invalid UTF-8 is read as U+FFFD; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wapspark.llm import words as W
from wapspark.llm.pretokens import PretokenCache, valid_chunk

# States of the transducer held by a worker; beyond it they are made anew.
MAX_STATES = 1 << 19


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(ranks: dict[bytes, int], text: bytes, below: int | None = None) -> list[int]:
    """BPE of a short byte string by merging the lowest rank first; only
    merges of ranks under ``below`` if given."""
    limit = len(ranks) + 256 if below is None else below
    parts = [text[i:i + 1] for i in range(len(text))]
    while len(parts) > 1:
        best, at = min((ranks.get(parts[i] + parts[i + 1], limit), i)
                       for i in range(len(parts) - 1))
        if best >= limit:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Lazily determinised transducer from bytes to token ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        self.fits: dict[tuple[int, int], bool] = {}
        # The two tokens whose merge makes a token; None for single bytes and
        # for tokens that BPE doesn't give for their own bytes.
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.prefixes = {b[:k] for b in ranks for k in range(1, len(b))}
        self.shapes: dict[bytes, tuple] = {}
        self._clear()

    def _clear(self) -> None:
        # A state: (last token out, suffix, waiting tokens at each place).
        self.states = [(None, b"", ((),))]
        self.number = {self.states[0]: 0}
        # Transitions by 256 * state + byte.
        self.next: dict[int, tuple[int, tuple]] = {}

    def _split(self, token: int) -> tuple[int, int] | None:
        if token not in self.halves:
            parts = merge(self.ranks, self.tokens[token], token)
            self.halves[token] = tuple(parts) if len(parts) == 2 else None
        return self.halves[token]

    def _fit(self, left: int | None, right: int) -> bool:
        """Whether BPE keeps ``left`` and ``right`` side by side.

        Going back in time from the finished tokens, the later one of the two
        that touch is taken apart; had the touching parts merged before the
        part of one of them did, the boundary would be gone. Of equal ranks
        the left merge comes first."""
        if left is None:
            return len(self.tokens[right]) == 1 or self._split(right) is not None
        key = (left, right)
        known = self.fits.get(key)
        if known is not None:
            return known
        if len(self.fits) > 4 * MAX_STATES:
            self.fits.clear()
        tokens, ranks, limit = self.tokens, self.ranks, len(self.ranks)
        fit = self._fit(None, left) and self._fit(None, right)
        while fit:
            across = ranks.get(tokens[left] + tokens[right])
            if across is not None and across < limit:
                fit = False
            elif left > right and len(tokens[left]) > 1:
                limit = left
                left = self._split(left)[1]
            elif len(tokens[right]) > 1:
                limit = right + 1
                right = self._split(right)[0]
            elif len(tokens[left]) > 1:
                limit = left
                left = self._split(left)[1]
            else:
                break
        self.fits[key] = fit
        return fit

    def _step(self, state: int, byte: int):
        """Makes the transition: (next state, tokens emitted)."""
        out, suffix, waiting = self.states[state]
        text = suffix + bytes((byte,))
        shape = self.shapes.get(text)
        if shape is None:
            shape = self.shapes[text] = self._shape(text)
        endings, drop = shape
        for k, token in endings:
            before = waiting[k]
            if self._fit(before[-1] if before else out, token):
                grown = before + (token,)
                break
        places = waiting[drop:] + (grown,)
        emitted = ()
        if () not in places:
            agreed, shortest = 0, min(map(len, places))
            while agreed < shortest and len({p[agreed] for p in places}) == 1:
                agreed += 1
            if agreed:
                emitted = grown[:agreed]
                out = emitted[-1]
                places = tuple(p[agreed:] for p in places)
        made = (out, text[drop:], places)
        number = self.number.get(made)
        if number is None:
            number = self.number[made] = len(self.states)
            self.states.append(made)
        step = self.next[state << 8 | byte] = (number, emitted)
        return step

    def _shape(self, text: bytes):
        """Of what has been read and may still matter: the tokens it ends in,
        and how far from its start no token can begin any more."""
        endings = [(k, self.ranks[text[k:]]) for k in range(len(text)) if text[k:] in self.ranks]
        drop = 0
        while drop < len(text) and text[drop:] not in self.prefixes:
            drop += 1
        return endings, drop

    def encode(self, text: bytes) -> list[int]:
        """Ids of one pre-token."""
        if len(self.states) > MAX_STATES:
            self._clear()
        if len(self.shapes) > MAX_STATES:
            self.shapes.clear()
        state, ids, steps = 0, [], self.next
        for byte in text:
            step = steps.get(state << 8 | byte)
            if step is None:
                step = self._step(state, byte)
            state = step[0]
            if step[1]:
                ids.extend(step[1])
        ids.extend(self.states[state][2][-1])
        return ids


class Utf8Stream:
    """Text of pieces of bytes; an unfinished character waits for the next."""

    def __init__(self):
        self.waiting = b""

    def push(self, piece: bytes) -> str:
        data = self.waiting + piece
        cut = len(data)
        # The last lead byte within three of the end tells what is missing.
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4 if byte < 0xF8 else 1
                cut = len(data) - back if need > back else cut
                break
            if byte < 0x80:
                break
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """Encoder and decoder of one vocabulary, as a worker holds it."""

    def __init__(self, path: str, pattern: str):
        ranks = load_ranks(path)
        self.transducer = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        self.cache = PretokenCache(lambda parts: [self.transducer.encode(p) for p in parts])
        size = max(ranks.values()) + 1
        lengths = np.zeros(size, np.int64)
        for token, i in ranks.items():
            lengths[i] = len(token)
        self.first = np.concatenate(([0], np.cumsum(lengths)))
        self.bytes = np.zeros(self.first[-1], np.uint8)
        for token, i in ranks.items():
            self.bytes[self.first[i]:self.first[i + 1]] = np.frombuffer(token, np.uint8)

    def encode_text(self, text: str) -> list[int]:
        return [i for part in self.pattern.findall(text)
                for i in self.transducer.encode(part.encode("utf-8"))]

    def encode_chunk(self, chunk: W.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunk's texts and the rows' bounds."""
        return self.cache.row_ids(valid_chunk(chunk), self.encode_text)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        sizes = self.first[ids + 1] - self.first[ids]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return self.bytes[np.repeat(self.first[ids] - ends[:-1], sizes)
                          + np.arange(ends[-1])].tobytes()

    def decode(self, ids: np.ndarray, piece: int = 1 << 16):
        """Text of ``ids``, piece by piece."""
        stream = Utf8Stream()
        for lo in range(0, len(ids), piece):
            yield stream.push(self.decode_bytes(ids[lo:lo + piece].astype(np.int64)))
        yield stream.close()


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec of a vocabulary; made once and kept between tasks."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """The id and the token ids (``ids``, array of int) of every row."""
    narrow = docs.select(id_col, text_col)
    schema = T.StructType([T.StructField(id_col, narrow.schema[id_col].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])

    @W.give_back
    def run(batches):
        for batch in batches:
            for chunk in W.text_chunks(batch.column(1)):
                ids, bounds = codec(path, pattern).encode_chunk(chunk)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.rows),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()),
                                              pa.array(ids.astype(np.int32)))],
                    names=[id_col, "ids"])

    return narrow.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per row the number of ids, a hash of them, and a hash of what they
    decode to."""
    narrow = docs.select(id_col, text_col)
    schema = T.StructType([T.StructField(id_col, narrow.schema[id_col].dataType),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])

    @W.give_back
    def run(batches):
        own = codec(path, pattern)
        decimals = np.array([str(i) for i in range(len(own.first))], object)
        for batch in batches:
            for chunk in W.text_chunks(batch.column(1)):
                ids, bounds = own.encode_chunk(chunk)
                text = decimals[ids]
                seen, back = [], []
                for r in range(chunk.rows):
                    lo, hi = bounds[r], bounds[r + 1]
                    seen.append(hashlib.sha256(" ".join(text[lo:hi]).encode()).hexdigest())
                    decoded = hashlib.sha256()
                    for part in own.decode(ids[lo:hi]):
                        decoded.update(part.encode("utf-8"))
                    back.append(decoded.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.rows),
                     pa.array(np.diff(bounds).astype(np.int64)), pa.array(seen), pa.array(back)],
                    names=schema.names)

    return narrow.mapInArrow(run, schema)
