"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

In a BPE encoding every token depends on its neighbour only: a sequence of tokens is the encoding of its text if each
two that meet are (Berglund and van der Merwe, "Formalizing BPE tokenization"). So the encoding of a prefix ends in
the one token that fits what the shorter prefix ends in, and a deterministic transducer reads a text once. Its state
is, for each place where a token that is still growing could start, its node in a trie of the tokens, the token before
the place and the count there. A transition carries how many tokens its character adds to the count of the prefix,
which may be negative when tokens merge. States are compiled when first reached.

A chunk of text is a map from entry states to exit states and counts, kept as a table. From the first place that no
token can span the map no longer depends on its entry, so only the head before it is read for each entry; the rest is read
once. The table of a chunk starts with the entry that the text just before the chunk leads to from the start state, which
is nearly always the true one, as states forget what is far behind; an entry that a table lacks is added when maps are
composed, so counts are exact whatever was expected. Maps compose associatively; a scan composes the chunks of a long text
in pairs.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import map_rows

SPACE = "▁"
_CHUNK = 1 << 16
#: Characters before a chunk from which its entry state is expected.
_BEFORE = 256
_ANEW = re.compile(f"[^{SPACE}](?={SPACE})")
_NEVER = float("inf")


def _fields(data: bytes):
    """(number, value) of a protocol-buffer message: ints, or bytes for anything with a length."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


def read_vocabulary(path: str) -> dict[str, float]:
    """The normal pieces and their scores of a sentencepiece BPE model with byte fallback and no normalisation."""
    pieces: dict[str, float] = {}
    kind, fallback, identity, prefix, squeeze = 1, 0, True, 1, 1
    with open(path, "rb") as f:
        data = f.read()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            if piece.get(3, 1) == 1:
                pieces[piece[1].decode()] = struct.unpack("<f", piece[2])[0]
            elif piece[3] in (4, 5):
                raise ValueError("user-defined and unused pieces are not supported")
        elif number == 2:
            spec = dict(_fields(value))
            kind, fallback = spec.get(3, 1), spec.get(35, 0)
        elif number == 3:
            spec = dict(_fields(value))
            identity, prefix, squeeze = not spec.get(2), spec.get(3, 1), spec.get(4, 1)
    if kind != 2 or not fallback or not identity or not prefix or squeeze:
        raise ValueError("the model must be BPE with byte fallback, a space put in front, and no other normalisation")
    return pieces


class State(dict):
    """Transitions: character -> (next state, tokens added)."""

    __slots__ = ("places",)


class ChunkMap:
    """A table from entry to (exit, count), both given as places; ``read`` finds the row of an entry that it lacks."""

    __slots__ = ("table", "read")

    def __init__(self, read: Callable[[tuple], tuple[tuple, int]], *entries: tuple):
        self.read, self.table = read, {}
        for entry in entries:
            self.at(entry)

    def at(self, entry: tuple) -> tuple[tuple, int]:
        if (row := self.table.get(entry)) is None:
            row = self.table[entry] = self.read(entry)
        return row

    def then(self, right: ChunkMap) -> ChunkMap:
        """First this map, then ``right``: for every entry of this table."""

        def read(entry: tuple) -> tuple[tuple, int]:
            middle, count = self.at(entry)
            end, more = right.at(middle)
            return end, count + more

        return ChunkMap(read, *self.table)


class Transducer:
    """Counts the tokens of texts. At most ``most_states`` and ``most_words`` are remembered at a time."""

    def __init__(self, pieces: dict[str, float], most_states: int = 1 << 17, most_words: int = 1 << 18):
        self.most_states, self.most_words = most_states, most_words
        self.rank = {p: -score for p, score in pieces.items()}
        self.characters = {c for p in pieces for c in p}
        self.tokens = [t for t in self.characters | pieces.keys() if self.encode(t) == [t]]
        self.costs = [1 if t in pieces else len(t.encode()) for t in self.tokens]
        #: A trie of the tokens: children by character, and the token that ends at a node, or -1.
        self.children: list[dict[str, int]] = [{}]
        self.ends = [-1]
        for number, token in enumerate(self.tokens):
            node = 0
            for c in token:
                if (child := self.children[node].get(c)) is None:
                    child = self.children[node][c] = len(self.ends)
                    self.children.append({})
                    self.ends.append(-1)
                node = child
            self.ends[node] = number
        if any(SPACE in t.lstrip(SPACE) for t in self.tokens):
            raise ValueError("pieces with a space behind another character are not supported")
        self.inside = {t[i : i + 2] for t in self.tokens for i in range(len(t) - 1)}
        self.fits: dict[int, bool] = {}
        self.states: dict[tuple, State] = {}
        self.words: dict[str, int] = {}
        self.start = self._state(((0, -1, 0),))

    def encode(self, text: str) -> list[str]:
        """Plain BPE of a short text: the best pair, leftmost first, until none merges."""
        parts, get = list(text), self.rank.get
        rank = [get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while rank and (low := min(rank)) != _NEVER:
            i = rank.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del rank[i]
            if i < len(rank):
                rank[i] = get(parts[i] + parts[i + 1], _NEVER)
            if i:
                rank[i - 1] = get(parts[i - 1] + parts[i], _NEVER)
        return parts

    def _meet(self, before: int, token: int) -> bool:
        """Whether the two tokens stand as they are when they meet."""
        key = before << 32 | token
        if (found := self.fits.get(key)) is None:
            if len(self.fits) >= 1 << 19:
                self.fits.clear()
            left, right = self.tokens[before], self.tokens[token]
            found = self.fits[key] = left[-1] + right[0] not in self.inside or self.encode(left + right) == [left, right]
        return found

    def _state(self, places: tuple) -> State:
        if (state := self.states.get(places)) is None:
            state = self.states[places] = State()
            state.places = places
        return state

    def _step(self, state: State, c: str) -> tuple[State, int]:
        """Compiles one transition. places: trie node of the text from there, token before it, count less that here."""
        if c not in self.characters:  # its bytes; nothing merges with them
            made = state[c] = (self.start, len(c.encode()))
            return made
        places, last = [], -1
        for node, before, count in state.places:
            node = self.children[node].get(c)
            if node is not None:
                token = self.ends[node]
                if last < 0 and token >= 0 and (before < 0 or self._meet(before, token)):
                    last, added = token, count + self.costs[token]
                if self.children[node]:
                    places.append((node, before, count))
        if last < 0:
            raise AssertionError(f"no token ends with {c!r}")
        state[c] = made = (self._state((*[(n, b, count - added) for n, b, count in places], (0, last, 0))), added)
        return made

    def run(self, text: str, state: State) -> tuple[State, int]:
        """The state after text and the tokens it adds, from a state."""
        count = 0
        for c in text:
            state, added = state.get(c) or self._step(state, c)
            count += added
        if len(self.states) > self.most_states:
            self.states.clear()  # states in use keep their transitions; new ones are compiled anew
            self.start = self._state(((0, -1, 0),))
        return state, count

    def _word(self, word: str) -> int:
        """Tokens of a space and word, from the start state; short words are remembered."""
        count = self.run(SPACE + word, self.start)[1]
        if len(word) <= 32:
            if len(self.words) >= self.most_words:
                self.words.clear()
            self.words[word] = count
        return count

    def _words(self, words: list[str]) -> int:
        """Tokens of words, each with a space in front, from the start state; an empty one is a space more for the next."""
        if "" in words:
            joined, spaces = [], ""
            for w in words:
                if w:
                    joined.append(spaces + w)
                    spaces = ""
                else:
                    spaces += SPACE
            words = joined
        counts = [self.words.get(w) for w in words]
        return sum([self._word(w) if n is None else n for w, n in zip(words, counts, strict=True)] if None in counts else counts)

    def chunk(self, text: str, entry: tuple) -> ChunkMap:
        """The map of a chunk, whose spaces are SPACE, with a row for ``entry``.

        A space behind another character is where no token can span: what is read from there on starts anew.
        """
        first = next((m.start() + 1 for m in _ANEW.finditer(text)), len(text))
        head, rest = text[:first], text[first:]
        state, count = self.start, 0
        if rest:
            last = rest.rstrip(SPACE).rfind(SPACE) if rest.strip(SPACE) else 0
            while last > 0 and rest[last - 1] == SPACE:
                last -= 1
            count = self._words(rest[1:last].split(SPACE)) if last > 0 else 0
            state, tail = self.run(rest[max(last, 0) :], self.start)
            count += tail
        places = state.places

        def read(entry: tuple) -> tuple[tuple, int]:
            end, added = self.run(head, self._state(entry))
            return (places, added + count) if rest else (end.places, added)

        return ChunkMap(read, entry)

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        begin = self.start.places
        maps = [self.chunk(text[i : i + _CHUNK], self.run(text[max(0, i - _BEFORE) : i], self.start)[0].places) for i in range(0, len(text), _CHUNK)]
        while len(maps) > 1:
            maps = [a.then(b) for a, b in zip(maps[::2], maps[1::2], strict=False)] + maps[len(maps) - len(maps) % 2 :]
        return maps[0].at(begin)[1]


@cache
def transducer(path: str) -> Transducer:
    """One for each worker process."""
    return Transducer(read_vocabulary(path))


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens) per row of docs.

    Null text is empty and has no tokens. Strings of special tokens inside a text are ordinary text. Whole texts are
    counted, of any length. Other columns of docs are not read. ``path`` is read by each executor, so it must be a
    file that all of them have.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        count = transducer(path).count
        n = [count(t or "") for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    return map_rows(rows, f"doc_id {kind}, n_bytes long, n_tokens long", each).withColumn("over_limit", F.col("n_tokens") > limit)
