"""Media columns: ISO base media containers as rows, without decoding a payload.

``probe`` walks the nested boxes of a file, decodes the sample tables (times, sizes, chunks, chunk offsets, sync
samples, and the runs of movie fragments) and returns codec, duration and the byte ranges of keyframes. ``store``
writes the bytes of texts as a file of raw video, 8 by 8 pixels of 3 bytes to a frame, so that a payload can be put into
a container and read back by the same tables.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import map_rows

FRAME = 192
#: Every so many frames one is listed as a sync sample.
KEY_EVERY = 12
TIMESCALE, TICKS = 25_000, 1_000
PAD = b" "

#: Boxes that hold boxes. Fixed values of the format.
CONTAINERS = frozenset({b"moov", b"trak", b"mdia", b"minf", b"stbl", b"moof", b"traf", b"mvex", b"edts", b"dinf"})


class BadMedia(ValueError):
    """The bytes aren't a container that can be read."""


# --- reading

def boxes(data: memoryview, start: int, end: int):
    """(type, body's start, body's end) of the boxes side by side in data[start:end]."""
    at = start
    while at < end:
        if end - at < 8:
            raise BadMedia(f"{end - at} stray bytes at {at}")
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1:
            if end - at < 16:
                raise BadMedia(f"a cut large box at {at}")
            size, head = struct.unpack_from(">Q", data, at + 8)[0], 16
        elif size == 0:
            size = end - at
        if size < head or at + size > end:
            raise BadMedia(f"box {kind!r} at {at} of {size} bytes goes beyond {end}")
        yield kind, at + head, at + size
        at += size


@dataclass
class Track:
    number: int = 0
    handler: str = ""
    codec: str = ""
    timescale: int = 0
    duration: int = 0
    found: dict[bytes, tuple[int, int]] = field(default_factory=dict)
    # of fragments
    sizes: list[np.ndarray] = field(default_factory=list)
    offsets: list[np.ndarray] = field(default_factory=list)
    syncs: list[np.ndarray] = field(default_factory=list)
    fragment_ticks: int = 0


def _table(data: memoryview, body: tuple[int, int], columns: int, skip: int = 4, kind: str = ">u4") -> np.ndarray:
    """The rows of a full box: version and flags, ``skip`` - 4 bytes, a count, then columns of big-endian integers."""
    at = body[0] + skip
    if at + 4 > body[1]:
        raise BadMedia("a cut table")
    count = struct.unpack_from(">I", data, at)[0]
    width = columns * np.dtype(kind).itemsize
    if at + 4 + count * width > body[1]:
        raise BadMedia(f"a table of {count} rows is cut")
    return np.frombuffer(data, kind, count * columns, at + 4).astype(np.int64).reshape(count, columns)


def _versioned(data: memoryview, body: tuple[int, int]) -> tuple[int, int]:
    """Timescale and duration of mdhd or mvhd."""
    if data[body[0]] == 1:
        return struct.unpack_from(">IQ", data, body[0] + 20)
    return struct.unpack_from(">II", data, body[0] + 12)


class Container:
    """A parsed file: ``brand`` and ``tracks``."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        self.brand, self.tracks, self.defaults = "", [], {}
        try:
            for kind, start, end in boxes(self.data, 0, len(data)):
                if kind in (b"ftyp", b"styp") and not self.brand:
                    self.brand = bytes(data[start : start + 4]).decode("latin-1")
                elif kind == b"moov":
                    self._moov(start, end)
                elif kind == b"moof":
                    self._moof(start, end, start - 8)
        except (struct.error, IndexError) as e:
            raise BadMedia(f"a box is cut: {e}") from e
        if not self.tracks:
            raise BadMedia("no track")

    def _walk(self, start: int, end: int) -> dict[bytes, tuple[int, int]]:
        """The first box of each type at any depth; boxes that wait are on a stack, so nesting has no limit."""
        found: dict[bytes, tuple[int, int]] = {}
        stack = [boxes(self.data, start, end)]
        while stack:
            kind, a, b = next(stack[-1], (None, 0, 0))
            if kind is None:
                stack.pop()
            elif kind in CONTAINERS:
                stack.append(boxes(self.data, a, b))
            else:
                found.setdefault(kind, (a, b))
        return found

    def _count(self, count: int, size: int = 1) -> int:
        """count, which no table may claim if its samples don't fit the file."""
        if count * max(size, 1) > len(self.data):
            raise BadMedia(f"{count} samples of {size} bytes don't fit the file")
        return count

    def _moov(self, start: int, end: int) -> None:
        for kind, a, b in boxes(self.data, start, end):
            if kind == b"trak":
                self.tracks.append(self._trak(a, b))
            elif kind == b"mvex":
                for inner, c, _ in boxes(self.data, a, b):
                    if inner == b"trex":
                        number, _, duration, size, flags = struct.unpack_from(">5I", self.data, c + 4)
                        self.defaults[number] = (duration, size, flags)

    def _trak(self, start: int, end: int) -> Track:
        found, data = self._walk(start, end), self.data
        track = Track(found=found)
        if b"tkhd" in found:
            at = found[b"tkhd"][0]
            track.number = struct.unpack_from(">I", data, at + (20 if data[at] == 1 else 12))[0]
        if b"mdhd" in found:
            track.timescale, track.duration = _versioned(data, found[b"mdhd"])
        if b"hdlr" in found:
            track.handler = bytes(data[found[b"hdlr"][0] + 8 : found[b"hdlr"][0] + 12]).decode("latin-1")
        if b"stsd" in found and found[b"stsd"][1] - found[b"stsd"][0] >= 16:
            track.codec = bytes(data[found[b"stsd"][0] + 12 : found[b"stsd"][0] + 16]).decode("latin-1")
        return track

    def _moof(self, start: int, end: int, base: int) -> None:
        for kind, a, b in boxes(self.data, start, end):
            if kind == b"traf":
                self._traf(a, b, base)

    def _traf(self, start: int, end: int, base: int) -> None:
        data, track, at, ticks, size, flags_of = self.data, None, base, 0, 0, 0
        for kind, a, _ in boxes(data, start, end):
            flags = struct.unpack_from(">I", data, a)[0] & 0xFFFFFF
            if kind == b"tfhd":
                number = struct.unpack_from(">I", data, a + 4)[0]
                track = next((t for t in self.tracks if t.number == number), None)
                ticks, size, flags_of = self.defaults.get(number, (0, 0, 0))
                place = a + 8
                if flags & 0x1:
                    at, place = struct.unpack_from(">Q", data, place)[0], place + 8
                place += 4 * bool(flags & 0x2)
                if flags & 0x8:
                    ticks, place = struct.unpack_from(">I", data, place)[0], place + 4
                if flags & 0x10:
                    size, place = struct.unpack_from(">I", data, place)[0], place + 4
                if flags & 0x20:
                    flags_of = struct.unpack_from(">I", data, place)[0]
                origin = at
            elif kind == b"trun" and track is not None:
                count, place = self._count(struct.unpack_from(">I", data, a + 4)[0]), a + 8
                if flags & 0x1:
                    at, place = origin + struct.unpack_from(">i", data, place)[0], place + 4
                first = struct.unpack_from(">I", data, place)[0] if flags & 0x4 else flags_of
                place += 4 * bool(flags & 0x4)
                columns = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
                if place + 4 * count * len(columns) > end:
                    raise BadMedia("a cut run of samples")
                rows = np.frombuffer(data, ">u4", count * len(columns), place).astype(np.int64).reshape(count, len(columns))
                by = {bit: rows[:, i] for i, bit in enumerate(columns)}
                sizes = by[0x200] if 0x200 in by else np.full(self._count(count, size), size, np.int64)
                how = by.get(0x400, np.r_[first, np.full(max(count - 1, 0), flags_of, np.int64)][:count].astype(np.int64))
                track.sizes.append(sizes)
                track.offsets.append(at + np.cumsum(sizes) - sizes)
                track.syncs.append((how >> 16 & 1) == 0)
                track.fragment_ticks += int(by[0x100].sum()) if 0x100 in by else ticks * count
                at += int(sizes.sum())

    def samples(self, track: Track) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offset, size and "is a sync sample" of every sample, in decoding order."""
        found, data = track.found, self.data
        if b"stsz" in found:
            size, count = struct.unpack_from(">II", data, found[b"stsz"][0] + 4)
            sizes = np.full(self._count(count, size), size, np.int64) if size else _table(data, found[b"stsz"], 1, skip=8)[:, 0]
        elif b"stz2" in found:
            bits, count = struct.unpack_from(">BI", data, found[b"stz2"][0] + 7)
            if bits not in (4, 8, 16) or found[b"stz2"][0] + 12 + -(-count * bits // 8) > found[b"stz2"][1]:
                raise BadMedia(f"{count} sizes of {bits} bits")
            if bits == 4:
                nibbles = np.frombuffer(data, np.uint8, -(-count // 2), found[b"stz2"][0] + 12).astype(np.int64)
                sizes = np.stack([nibbles >> 4, nibbles & 15], axis=1).reshape(-1)[:count]
            else:
                sizes = _table(data, found[b"stz2"], 1, skip=8, kind=f">u{bits // 8}")[:, 0]
        else:
            sizes = np.zeros(0, np.int64)
        if b"co64" in found:
            chunks = _table(data, found[b"co64"], 1, kind=">u8")[:, 0]
        else:
            chunks = _table(data, found[b"stco"], 1)[:, 0] if b"stco" in found else np.zeros(0, np.int64)
        offsets = np.zeros(len(sizes), np.int64)
        if len(sizes):
            runs = _table(data, found[b"stsc"], 3) if b"stsc" in found else np.zeros((0, 3), np.int64)
            if not len(runs) or runs[0, 0] != 1 or (np.diff(runs[:, 0]) <= 0).any():
                raise BadMedia("chunks without samples")
            firsts = np.minimum(np.r_[runs[:, 0], len(chunks) + 1], len(chunks) + 1)
            each = np.repeat(runs[:, 1], np.diff(firsts))
            if each.sum() < len(sizes):
                raise BadMedia("samples without chunks")
            chunk = np.searchsorted(np.cumsum(each), np.arange(len(sizes)), "right")
            before = np.cumsum(sizes) - sizes
            first = np.r_[True, chunk[1:] != chunk[:-1]]
            offsets = chunks[chunk] + before - np.maximum.accumulate(np.where(first, before, 0))
        sync = np.ones(len(sizes), bool)
        if b"stss" in found:
            listed = _table(data, found[b"stss"], 1)[:, 0]
            sync[:] = False
            sync[listed[(listed >= 1) & (listed <= len(sizes))] - 1] = True
        out = [np.concatenate([a, *b]) for a, b in ((offsets, track.offsets), (sizes, track.sizes), (sync, track.syncs))]
        if len(out[0]) and (out[0].min() < 0 or (out[0] + out[1]).max() > len(self.data)):
            raise BadMedia("samples beyond the file")
        return out[0], out[1], out[2].astype(bool)

    def duration(self, track: Track) -> float:
        """Seconds, by the samples' times, else by the header."""
        ticks = sum(n * each for n, each in _table(self.data, track.found[b"stts"], 2).tolist()) if b"stts" in track.found else 0
        ticks = ticks + track.fragment_ticks or track.duration
        return ticks / track.timescale if track.timescale else 0.0

    def payload(self, track: Track) -> bytes:
        """The stored bytes of all samples, in decoding order."""
        offsets, sizes, _ = self.samples(track)
        if len(sizes) and (offsets[1:] == offsets[:-1] + sizes[:-1]).all():
            return bytes(self.data[int(offsets[0]) : int(offsets[-1] + sizes[-1])])
        if sizes.sum() > len(self.data):
            raise BadMedia("samples that overlap have more bytes than the file")
        return b"".join(self.data[a : a + n] for a, n in zip(offsets.tolist(), sizes.tolist(), strict=True))


# --- writing

def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def _listed(kind: bytes, values: np.ndarray, code: str = ">u4") -> bytes:
    return _full(kind, struct.pack(">I", len(values)), values.astype(code).tobytes())


def padded(data: bytes) -> bytes:
    """data with bytes 32 up to a positive multiple of a frame."""
    return data + PAD * (max(1, -(-len(data) // FRAME)) * FRAME - len(data))


def mux(payload: bytes) -> bytes:
    """A file with one track of raw 8 x 8 RGB frames that hold payload; equal payloads give equal files."""
    if not payload or len(payload) % FRAME:
        raise ValueError(f"the payload must be a positive multiple of {FRAME} bytes")
    frames = len(payload) // FRAME
    ticks = frames * TICKS
    unity = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HH", 8, 8), struct.pack(">III", 0x480000, 0x480000, 0), struct.pack(">H", 1), bytes(32), struct.pack(">Hh", 24, -1))
    head = _box(b"ftyp", b"isom", struct.pack(">I", 0x200), b"isomqt  ")

    def moov(offset: int) -> bytes:
        table = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, frames, TICKS)),
            _full(b"stsc", struct.pack(">IIII", 1, 1, frames, 1)),
            _full(b"stsz", struct.pack(">II", FRAME, frames)),
            _listed(b"co64", np.array([offset]), ">u8"),
            _listed(b"stss", np.arange(1, frames + 1, KEY_EVERY)),
        )
        info = _box(b"minf", _full(b"vmhd", bytes(8), flags=1), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), table)
        media = _box(b"mdia", _full(b"mdhd", struct.pack(">QQIQ", 0, 0, TIMESCALE, ticks), struct.pack(">HH", 0x55C4, 0), version=1), _full(b"hdlr", bytes(4), b"vide", bytes(12), b"\0"), info)
        track = _full(b"tkhd", struct.pack(">QQIIQ", 0, 0, 1, 0, ticks), bytes(16), unity, struct.pack(">II", 8 << 16, 8 << 16), version=1, flags=3)
        movie = _full(b"mvhd", struct.pack(">QQIQ", 0, 0, TIMESCALE, ticks), struct.pack(">IH", 0x10000, 0x100), bytes(10), unity, bytes(24), struct.pack(">I", 2), version=1)
        return _box(b"moov", movie, _box(b"trak", track, media))

    large = 8 if len(payload) + 8 >= 1 << 32 else 0
    offset = len(head) + len(moov(0)) + 8 + large
    return head + moov(offset) + _box(b"mdat", payload)


# --- columns

TRACKS = "array<struct<track_id: long, handler: string, codec: string, timescale: long, duration_s: double, n_samples: long, keyframes: array<struct<start: long, end: long>>>>"


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each row's text as UTF-8 in a container. Null text is empty; the shortest payload is one frame.

    Other columns of docs are not read.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([mux(padded((t or "").encode())) for t in batch.column(1).to_pylist()], pa.binary())], ["doc_id", "n_bytes", "media"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    return map_rows(rows, f"doc_id {kind}, n_bytes long, media binary", each, rows=128)


def probe(media: DataFrame, with_payload: bool = False) -> DataFrame:
    """The columns of media with brand, tracks and error beside them, and with the first track's payload if asked for.

    media: a binary column ``media`` beside any others. A null or a file that can't be read has null brand and tracks
    and says why in ``error``; a row is never dropped. Keyframes are byte ranges [start, end) of the file, one for each
    sync sample; a track without a list of sync samples has all of them. No sample is decoded.
    The new columns must not clash with those of media: a clash is an error.
    """
    at = media.columns.index("media")
    added = ["brand", "tracks", "error", *["payload"] * with_payload]
    if clash := {c.lower() for c in media.columns} & set(added):
        raise ValueError(f"media already has {sorted(clash)}")
    kinds = pa.list_(pa.struct([("track_id", pa.int64()), ("handler", pa.string()), ("codec", pa.string()), ("timescale", pa.int64()), ("duration_s", pa.float64()), ("n_samples", pa.int64()), ("keyframes", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]))

    def one(data: bytes | None) -> tuple:
        if data is None:
            return None, None, "null", None
        try:
            file = Container(data)
            tracks = []
            for t in file.tracks:
                offsets, sizes, sync = file.samples(t)
                keys = [{"start": a, "end": a + n} for a, n in zip(offsets[sync].tolist(), sizes[sync].tolist(), strict=True)]
                tracks.append({"track_id": t.number, "handler": t.handler, "codec": t.codec, "timescale": t.timescale, "duration_s": file.duration(t), "n_samples": len(sizes), "keyframes": keys})
            return file.brand, tracks, None, file.payload(file.tracks[0]) if with_payload else None
        except (ValueError, struct.error, TypeError, IndexError, OverflowError) as e:
            return None, None, str(e) or type(e).__name__, None

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        brand, tracks, error, payload = zip(*[one(d) for d in batch.column(at).to_pylist()], strict=True)
        new = [pa.array(brand, pa.string()), pa.array(tracks, kinds), pa.array(error, pa.string()), *[pa.array(payload, pa.binary())] * with_payload]
        return pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *added])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in media.schema.fields], "brand string", f"tracks {TRACKS}", "error string", *["payload binary"] * with_payload])
    return map_rows(media, schema, each, rows=128)
