"""Byte-level BPE: pre-tokenisation by scans over code-point classes, then pair merging behind a cache.

The split into pieces is that of the usual pattern (contractions, then letters, numbers or other signs after at most
one space, then white space), found without a regular expression. Each code point becomes a symbol: its class,
and for white space and apostrophes what the next one or two code points make of it. A symbol is a function from the
splitter's state to its next state. Functions compose associatively, so a text is cut into columns of equal height,
each column's function is found for all states at once, a parallel prefix scan composes the columns, and a last pass
from the then known states marks where pieces start.
"""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import map_rows

# Symbols.
LETTER, NUMBER, OTHER, SHORT, LONG, SPACE, JOINS, ALONE, END = range(9)
# States: at a piece's start; in letters, numbers, others; after a space that joins what follows; in white space;
# one or two letters before the end of a contraction.
FRESH, IN_LETTER, IN_NUMBER, IN_OTHER, JOINING, IN_SPACE, ONE_LEFT, TWO_LEFT = range(8)
_HEIGHT = 64
_SEPARATOR = 0x110000
#: Code points or tokens of a long text that are handled at once, and where a text may be cut without cutting a piece.
_PART = 1 << 18
_CUT = re.compile(r"(?<=[^\s])[ \n]")

#: White space of the pattern's \s: the code points with the Unicode property White_Space. Fixed values.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a piece starts here", by symbol and state."""
    step = np.zeros((9, 8), np.uint8)
    starts = np.ones((9, 8), bool)
    for symbol, state in ((LETTER, IN_LETTER), (NUMBER, IN_NUMBER), (OTHER, IN_OTHER), (SPACE, IN_SPACE)):
        step[symbol] = state
        starts[symbol, state] = False
        if symbol != SPACE:
            starts[symbol, JOINING] = False
    step[LETTER, ONE_LEFT], step[LETTER, TWO_LEFT] = FRESH, ONE_LEFT
    starts[LETTER, [ONE_LEFT, TWO_LEFT]] = False
    for symbol, state in ((SHORT, ONE_LEFT), (LONG, TWO_LEFT)):  # an apostrophe within other signs is one of them
        step[symbol] = state
        step[symbol, [IN_OTHER, JOINING]] = IN_OTHER
        starts[symbol, [IN_OTHER, JOINING]] = False
    step[JOINS], step[ALONE], step[END] = JOINING, FRESH, FRESH
    return step, starts


@cache
def _classes() -> np.ndarray:
    """Class of each code point, with the separator as END."""
    out = np.full(_SEPARATOR + 1, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    out[:_SEPARATOR] = [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(_SEPARATOR)]
    out[WHITE_SPACE] = SPACE
    out[_SEPARATOR] = END
    return out


def symbols(points: np.ndarray) -> np.ndarray:
    """The symbol of each code point; texts are ended by the separator."""
    out = _classes()[points]
    one, two = np.r_[points[1:], [_SEPARATOR]], np.r_[points[2:], [_SEPARATOR] * 2][: len(points)]
    last = (out == SPACE) & ~np.isin(np.r_[out[1:], [END]], (SPACE, END))
    out[last] = np.where(points[last] == 0x20, JOINS, ALONE)
    at = np.flatnonzero(points == ord("'"))
    a, b = one[at], two[at]
    out[at[np.isin(a, [ord(c) for c in "stmd"])]] = SHORT
    out[at[((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))]] = LONG
    return out


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each code point (separators start one of their own)."""
    step, starts = (x.reshape(-1) for x in _automaton())
    n = len(points)
    grid = np.full(-(-n // _HEIGHT) * _HEIGHT, END, np.intp)
    grid[:n] = symbols(points)
    grid = np.ascontiguousarray(grid.reshape(-1, _HEIGHT).T) * 8
    maps = np.tile(np.arange(8, dtype=np.uint8), (grid.shape[1], 1))
    for row in grid:
        maps = step[row[:, None] + maps]
    reach = 1
    while reach < len(maps):  # the scan: maps[i] becomes the function of everything up to column i
        maps = np.concatenate([maps[:reach], np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)])
        reach *= 2
    state = np.r_[np.uint8(FRESH), maps[:-1, FRESH]] if len(maps) else np.zeros(0, np.uint8)
    out = np.empty(grid.shape, bool)
    for i, row in enumerate(grid):
        at = row + state
        out[i] = starts[at]
        state = step[at]
    return out.T.reshape(-1)[:n]


#: The pattern that the automaton splits by. A fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteBPE:
    """Encodes by a file of ranks; ``most_cached`` pieces of at most ``_CACHED`` bytes are remembered."""

    _CACHED = 48

    def __init__(self, path: str, most_cached: int = 1 << 18):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.most_cached = most_cached
        self.known: dict[bytes, bytes] = {}
        tokens = sorted(self.ranks.items(), key=lambda x: x[1])
        size = tokens[-1][1] + 1
        self.length = np.zeros(size, np.int64)
        for token, rank in tokens:
            self.length[rank] = len(token)
        self.blob = np.frombuffer(b"".join(t for t, _ in tokens), np.uint8)
        self.place = np.cumsum(self.length) - self.length

    def merge(self, piece: bytes) -> bytes:
        """Ids of one piece as little-endian 32-bit integers: the pair of lowest rank, leftmost first, is merged."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return whole.to_bytes(4, "little")
        n = len(piece)
        if n > 128:
            cuts = self._merge_long(piece)
        else:
            cuts = list(range(n + 1))
            pair = [ranks.get(piece[i : i + 2], 1 << 60) for i in range(n - 1)]
            while pair:
                low = min(pair)
                if low == 1 << 60:
                    break
                i = pair.index(low)
                del cuts[i + 1]
                del pair[i]
                if i < len(pair):
                    pair[i] = ranks.get(piece[cuts[i] : cuts[i + 2]], 1 << 60)
                if i:
                    pair[i - 1] = ranks.get(piece[cuts[i - 1] : cuts[i + 1]], 1 << 60)
        return b"".join([ranks[piece[a:b]].to_bytes(4, "little") for a, b in zip(cuts, cuts[1:], strict=False)])

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same by a heap, for pieces where a search of all pairs at each merge would be slow."""
        n, ranks = len(piece), self.ranks
        after, before = list(range(1, n + 2)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        gone = bytearray(n + 1)
        while heap:
            _, i, end = heapq.heappop(heap)
            if gone[i] or after[i] >= n or after[after[i]] != end:
                continue
            middle = after[i]
            gone[middle] = 1
            after[i], before[end] = end, i
            if end < n and (r := ranks.get(piece[i : after[end]])) is not None:
                heapq.heappush(heap, (r, i, after[end]))
            if i and (r := ranks.get(piece[before[i] : end])) is not None:
                heapq.heappush(heap, (r, before[i], end))
        return [i for i in range(n) if not gone[i]] + [n]

    def _learn(self, piece: bytes) -> bytes:
        new = self.known.get(piece) or self.merge(piece)
        if len(piece) <= self._CACHED:
            if len(self.known) >= self.most_cached:
                self.known.clear()
            self.known[piece] = new
        return new

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.insert(points, np.cumsum(sizes), _SEPARATOR)
        starts = np.flatnonzero(piece_starts(points))
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        width[points == _SEPARATOR] = 0
        offset = np.r_[0, np.cumsum(width)]
        data = "".join(texts).encode()
        first = np.searchsorted(starts, np.r_[0, np.cumsum(sizes + 1)])
        at = offset[starts].tolist() + [len(data)]
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            cut = at[a:b]  # the last is the separator's, where the text ends
            pieces = [data[x:y] for x, y in zip(cut, cut[1:], strict=False)]
            found = list(map(self.known.get, pieces))
            if None in found:
                found = [self._learn(p) if f is None else f for p, f in zip(pieces, found, strict=True)]
            out.append(b"".join(found))
        return out

    def encode_long(self, text: str) -> bytes:
        """As encode_batch for a text of any length, by parts that end where a space follows another sign: a piece ends there."""
        out, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + _PART)
            end = cut.start() if cut else len(text)
            out += self.encode_batch([text[at:end]])
            at = end
        return b"".join(out)

    def offsets(self, ids: bytes) -> np.ndarray:
        """Where each token starts in its text's bytes, and the end of the last."""
        return np.r_[0, np.cumsum(self.length[np.frombuffer(ids, "<u4")])]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of all tokens: each byte's place in the vocabulary follows from its token's offset."""
        out = []
        for at in range(0, len(ids), 4 * _PART):
            tokens = np.frombuffer(ids[at : at + 4 * _PART], "<u4")
            length = self.length[tokens]
            ends = np.cumsum(length)
            where = np.repeat(self.place[tokens] - (ends - length), length) + np.arange(ends[-1])
            out.append(self.blob[where].tobytes())
        return b"".join(out)


@cache
def encoder(path: str) -> ByteBPE:
    """One for each worker process."""
    return ByteBPE(path)


def encode(docs: DataFrame, path: str, columns: tuple[str, ...] = ("ids", "offsets"), pattern: str = PATTERN) -> DataFrame:
    """doc_id and the binary ``columns`` asked for, per row of docs.

    ids: the tokens as little-endian unsigned 32-bit integers. offsets: where each token starts in the text's UTF-8,
    and its end, packed alike. decoded: the bytes that the ids decode to. Null text is empty and gives no ids and
    the one offset 0. Whole texts are encoded, of any length. Other columns of docs are not read. ``path`` is read by
    each executor, so it must be a file that all of them have. ``pattern`` says how its makers split texts: another than
    PATTERN is an error.
    """
    if pattern != PATTERN:
        raise ValueError("texts are split by another pattern than this encoder's")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoder(path)
        texts = [t or "" for t in batch.column(1).to_pylist()]
        ids = [bpe.encode_long(texts[0])] if len(texts) == 1 else bpe.encode_batch(texts)
        made = {"ids": lambda x: x, "offsets": lambda x: bpe.offsets(x).astype("<u4").tobytes(), "decoded": bpe.decode}
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([made[c](x) for x in ids], pa.binary()) for c in columns]], ["doc_id", *columns])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", F.col("text")), ", ".join([f"doc_id {kind}", *[f"{c} binary" for c in columns]]), each, rows=256, most_bytes=1 << 20)
