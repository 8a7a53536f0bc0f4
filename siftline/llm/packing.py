"""Hierarchical packing of tokenised documents into windows of several lengths.

A document gives as many full windows of the longest length as it fills; what is left is routed to the shortest tier
that holds it. Tiers are packed from the longest down: each remainder opens a window of its tier, the window's gap is
filled with the longest remainders of shorter tiers that fit, and what then is still open with a cut of the next one.
So windows are full, whatever their length, but for one at the end of a partition. Windows are dealt to step groups of
equal numbers of tokens. Each partition packs its own documents in blocks, with what stays open carried on: no shuffle,
and memory for one block.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from siftline.llm.common import frugal, slices

TIERS = (128, 256, 512, 1024)
STEP_TOKENS = 65_536
END_ID = 0
_BLOCK_TOKENS = 1 << 20
_SCHEMA = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, window int, step_group long"


class Ids:
    """Ids as the tokenizers library gives them for a file of byte-level BPE, without special tokens being added.

    Where the file is plain byte-level BPE whose merges are in the order of their ids, a rank-based encoder gives the
    same ids faster; a text that contains the string of a special token goes to the library itself, as do all texts
    of any other file and texts that the faster encoder gives up on.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.fast = self._ranked(spec)

    @staticmethod
    def _ranked(spec: dict):
        import tiktoken

        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        plain &= spec["normalizer"] is None and spec["truncation"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        if not plain:
            return None
        # Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        added = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(merged) or len(ranks) != 256 + len(merged) or (merged and merged[0] < 256):
            return None
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        try:
            return np.array(self.fast.encode_ordinary(text), "<u4")
        except BaseException as e:  # the encoder's pattern gives up on very long runs of white space; the library doesn't
            if type(e).__name__ != "PanicException":
                raise
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


@cache
def ids_of(path: str) -> Ids:
    """One for each worker process."""
    return Ids(path)


class Packer:
    """Packs remainders. A piece is (document, start, length); documents are whatever the caller uses as one."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
            raise ValueError("tiers must be rising powers of two")
        self.tiers = tiers
        self.left: list[list] = [[] for _ in tiers]  # by tier, (length, number, document, start), shortest first
        self.number = 0

    def _put(self, doc, start: int, length: int) -> None:
        tier = bisect_left(self.tiers, length)
        insort(self.left[tier], (length, self.number, doc, start))
        self.number += 1

    def add(self, doc, tokens: int) -> Iterator[tuple[int, list]]:
        """Full windows of the longest tier as (window, pieces); the remainder waits for ``pack``."""
        longest = self.tiers[-1]
        for start in range(0, tokens - longest + 1, longest):
            yield longest, [(doc, start, longest)]
        if rest := tokens % longest:
            self._put(doc, tokens - rest, rest)

    def _fill(self, window: int, tier: int) -> list:
        """A window of the tier: its longest remainder, then remainders of shorter tiers, then a cut."""
        pieces, gap = [], window
        opened = tier
        while gap:
            for shorter in range(opened, -1, -1):
                fitting = bisect_right(self.left[shorter], (gap, self.number)) - 1
                if fitting >= 0:
                    length, _, doc, start = self.left[shorter].pop(fitting)
                    break
            else:
                # None fits whole: cut the shortest there is, and route what is left of it again.
                cut = next((t for t in range(tier + 1) if self.left[t]), None)
                if cut is None:
                    break
                length, _, doc, start = self.left[cut].pop(0)
                self._put(doc, start + gap, length - gap)
                length = gap
            pieces.append((doc, start, length))
            gap -= length
            opened = min(opened, tier - 1) if tier else 0
        return pieces

    def pack(self, last: bool = False) -> Iterator[tuple[int, list]]:
        """(window, pieces) of all full windows; with ``last`` also of what remains, in one window of the longest tier.

        What would leave a window open goes back and waits for more documents, or for ``last``.
        """
        for tier in range(len(self.tiers) - 1, -1, -1):
            window = self.tiers[tier]
            while self.left[tier]:
                pieces = self._fill(window, tier)
                if sum(p[2] for p in pieces) == window:
                    yield window, pieces
                elif last:
                    yield self.tiers[-1], pieces
                else:
                    for doc, start, length in pieces:
                        self._put(doc, start, length)
                    return


def step_groups(windows: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group number for each window: longest first to the group with the fewest tokens, so groups are balanced."""
    count = max(1, -(-sum(windows) // step_tokens))
    loads = [(0, g) for g in range(count)]
    out = [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: -windows[i]):
        load, group = heapq.heappop(loads)
        out[i] = group
        heapq.heappush(loads, (load + windows[i], group))
    return out


def pack(docs: DataFrame, path: str, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """A row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset, window, step_group.

    ids holds the piece's tokens as little-endian unsigned 32-bit integers; doc_tokens counts the document's tokens with
    the id 0 that ends it. Pieces of a sequence have offsets from 0 without a gap, and their lengths add up to ``window``,
    a power of two, but for the last sequence of a partition, which is to be padded to the longest tier. Null and empty
    texts are the end id alone. Rows that repeat a doc_id are packed each for itself. An empty table gives no rows.
    Other columns of docs are not read. ``path`` must be a file that all executors have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = ids_of(path).encode, Packer(tiers)
        base = TaskContext.get().partitionId() << 40
        sequence = group = 0
        end = np.array([END_ID], "<u4")

        def rows(full: list[tuple[int, list]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, group
            groups = step_groups([w for w, _ in full], step_tokens)
            for at in range(0, len(full), 1024):
                out: list[tuple] = []
                for (window, pieces), g in zip(full[at : at + 1024], groups[at : at + 1024], strict=True):
                    offset = 0
                    for (key, ids), start, length in pieces:
                        out.append((key, start, length, ids[start : start + length].tobytes(), len(ids), base + sequence, offset, window, base + group + g))
                        offset += length
                    sequence += 1
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            group += max(groups, default=-1) + 1

        held: list[tuple[int, list]] = []
        tokens, schema = 0, None
        for batch in batches:
            if schema is None:
                kinds = [batch.schema.field(0).type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
                schema = pa.schema(list(zip(names, kinds, strict=True)))
            for part in slices(batch):
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.concatenate([encode(text or ""), end])
                    held += packer.add((key, ids), len(ids))
                    tokens += len(ids)
                    if tokens >= _BLOCK_TOKENS:
                        yield from rows([*held, *packer.pack()])
                        held, tokens = [], 0
        if schema is not None:
            yield from rows([*held, *packer.pack(), *packer.pack(last=True)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *[f.split()[0] for f in _SCHEMA.split(", ")]]
    return docs.select("doc_id", "text").mapInArrow(frugal(run), f"doc_id {kind}, {_SCHEMA}")
