"""Media columns as ISO media containers (boxes as in ISO/IEC 14496-12).

`write_media` lays a payload down as a sound track of 8-bit samples; `read_index` walks the nested boxes of such a file,
decodes the sample tables and gives codec, duration and the byte ranges of key frames without touching the payload;
`payload` reads the stored bytes back through the chunk and sample tables.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a frame, frames of a chunk, and every how many frames a key frame comes.
FRAME, CHUNK, KEY = 576, 16, 8
RATE = 8000
_NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf"}
_MATRIX = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def padded(text: str | None, frame: int = FRAME) -> tuple[int, bytes]:
    """Length in UTF-8 and the payload: filled with bytes 255 to a positive multiple of `frame`. Null is empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b"\xff" * (-len(raw) % frame or (0 if raw else frame))


def write_media(payload: bytes, frame: int = FRAME, chunk: int = CHUNK, key: int = KEY, rate: int = RATE) -> bytes:
    """A file of one track of raw 8-bit samples: ftyp, moov with all tables, mdat. Frames are samples in the box sense."""
    frames = len(payload) // frame
    chunks = -(-frames // chunk)
    ticks = frames * frame
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2mp41")
    entry = _box(b"raw ", b"\0" * 6, struct.pack(">HIIHHHHI", 1, 0, 0, 1, 8, 0, 0, rate << 16))
    last = frames - (chunks - 1) * chunk
    runs = [(1, chunk), (chunks, last)] if chunks > 1 and last != chunk else [(1, min(chunk, frames))]
    sync = range(1, frames + 1, key)

    def moov(data_at: int) -> bytes:
        step = chunk * frame
        wide = data_at + len(payload) >> 32
        offsets = struct.pack(f">{chunks}{'Q' if wide else 'I'}", *range(data_at, data_at + chunks * step, step))
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, frames, frame)),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", a, n, 1) for a, n in runs)),
            _full(b"stsz", struct.pack(">II", frame, frames)),
            _full(b"co64" if wide else b"stco", struct.pack(">I", chunks), offsets),
            _full(b"stss", struct.pack(f">I{len(sync)}I", len(sync), *sync)),
        )
        minf = _box(b"minf", _full(b"smhd", b"\0" * 4), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), stbl)
        mdhd = _full(b"mdhd", struct.pack(">QQIQHH", 0, 0, rate, ticks, 0x55C4, 0), version=1)
        mdia = _box(b"mdia", mdhd, _full(b"hdlr", struct.pack(">I4s12x", 0, b"soun"), b"bytes\0"), minf)
        tkhd = _full(b"tkhd", struct.pack(">QQIIQ8xHHHH", 0, 0, 1, 0, ticks, 0, 0, 256, 0), _MATRIX, b"\0" * 8, version=1, flags=7)
        mvhd = _full(b"mvhd", struct.pack(">QQIQIH10x", 0, 0, rate, ticks, 0x10000, 256), _MATRIX, b"\0" * 24, struct.pack(">I", 2), version=1)
        return _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))

    large = len(payload) + 8 >> 32
    head = struct.pack(">I4sQ", 1, b"mdat", len(payload) + 16) if large else struct.pack(">I4s", len(payload) + 8, b"mdat")
    size = len(moov(0)) if not len(payload) >> 31 else len(moov(1 << 32))
    return b"".join((ftyp, moov(len(ftyp) + size + len(head)), head, payload))


def boxes(data: memoryview, lo: int = 0, hi: int | None = None, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path of kinds, first byte of the body, end) of every box, parents before children. Raises on boxes that overrun."""
    hi = len(data) if hi is None else hi
    while lo < hi:
        if hi - lo < 8:
            raise ValueError("a box header is cut off")
        size, kind = struct.unpack_from(">I4s", data, lo)
        body = lo + 8
        if size == 1:
            size, body = struct.unpack_from(">Q", data, body)[0], body + 8
        elif size == 0:
            size = hi - lo
        if size < body - lo or lo + size > hi:
            raise ValueError(f"box {kind!r} doesn't fit its parent")
        yield (*path, kind), body, lo + size
        if kind in _NESTED:
            yield from boxes(data, body, lo + size, (*path, kind))
        lo += size


def _table(data: memoryview, at: int, fmt: str, skip: int = 4) -> list:
    n = struct.unpack_from(">I", data, at + skip)[0]
    return list(struct.iter_unpack(">" + fmt, data[at + skip + 4 : at + skip + 4 + n * struct.calcsize(">" + fmt)]))


def read_index(media: bytes) -> dict | None:
    """Codec, handler, timescale, duration (ticks), samples, and `keyframes`, a list of (first byte, end).

    Of the first track. None if there is no track; a damaged file raises ValueError.
    """
    data, at = memoryview(media), {}
    for path, body, end in boxes(data):
        if path[-1] == b"trak" and b"trak" in at:
            break
        at.setdefault(path[-1], (body, end))
    if b"stbl" not in at:
        return None
    start = lambda kind: at[kind][0]
    version = data[start(b"mdhd")]
    timescale, duration = struct.unpack_from(">IQ" if version else ">II", data, start(b"mdhd") + (20 if version else 12))
    codec = bytes(data[start(b"stsd") + 12 : start(b"stsd") + 16]).decode("latin-1")
    handler = bytes(data[start(b"hdlr") + 8 : start(b"hdlr") + 12]).decode("latin-1")
    same, count = struct.unpack_from(">II", data, start(b"stsz") + 4)
    sizes = [same] * count if same else [x for (x,) in _table(data, start(b"stsz"), "I", 8)]
    offsets = [x for (x,) in (_table(data, start(b"co64"), "Q") if b"co64" in at else _table(data, start(b"stco"), "I"))]
    runs = _table(data, start(b"stsc"), "III")
    ends = [r[0] for r in runs[1:]] + [len(offsets) + 1]
    spans, k = [], 0
    for (first, per_chunk, _), end in zip(runs, ends, strict=True):
        for c in range(first - 1, end - 1):
            pos = offsets[c]
            for _ in range(per_chunk):
                spans.append((pos, pos + sizes[k]))
                pos, k = pos + sizes[k], k + 1
    ticks = sum(n * d for n, d in _table(data, start(b"stts"), "II"))
    keys = [x for (x,) in _table(data, start(b"stss"), "I")] if b"stss" in at else range(1, count + 1)
    return {"codec": codec, "handler": handler, "timescale": timescale, "duration": duration, "ticks": ticks, "samples": spans, "keyframes": [spans[i - 1] for i in keys]}


def payload(media: bytes, index: dict) -> bytes:
    """The samples' bytes in order; neighbours are read together."""
    data, out, lo, hi = memoryview(media), [], None, None
    for a, b in index["samples"]:
        if a != hi:
            if hi is not None:
                out.append(data[lo:hi])
            lo = a
        hi = b
    return b"".join([*out, data[lo:hi]] if hi is not None else out)


def feature(index: dict) -> str:
    """Codec, seconds and key frames as text: count, first and last byte range, and a checksum over all ranges."""
    keys = index["keyframes"]
    crc = zlib.crc32(struct.pack(f">{2 * len(keys)}Q", *(x for k in keys for x in k)))
    ends = f"{keys[0][0]}-{keys[0][1]},{keys[-1][0]}-{keys[-1][1]}" if keys else "-"
    return f"codec={index['codec'].strip()};handler={index['handler']};seconds={index['duration'] / index['timescale']:.3f};frames={len(index['samples'])};keyframes={len(keys)};ranges={ends};crc={crc:08x}"


_SCHEMA = "id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codec string, duration double, keyframes array<struct<first:long,end:long>>, media binary"


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_media: bool = True, batch: int = 64) -> DataFrame:
    """One row per document with its text stored as media, what the container's tables say, and digests of what reads back.

    `media` is null unless keep_media. A null text is an empty one: a single frame of bytes 255. Equal texts give equal
    values, whatever their rows; an empty table gives no rows. Rows are made and handed on `batch` at a time, without a
    shuffle, so memory follows the longest texts rather than the table.
    """

    def make(batches):
        for b in batches:
            for lo in range(0, len(b), batch):
                ids, texts = b.column(0).slice(lo, batch), b.column(1).slice(lo, batch)
                yield pa.RecordBatch.from_arrays([ids, *_columns(texts.to_pylist(), keep_media)], names=names)

    names = [x.split(" ")[0] for x in _SCHEMA.split(", ")]
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(make, _SCHEMA)


def _columns(texts: list[str | None], keep_media: bool) -> list[pa.Array]:
    rows = []
    for text in texts:
        n, data = padded(text)
        media = write_media(data)
        index = read_index(media)
        back = payload(media, index)
        keys = [{"first": a, "end": b} for a, b in index["keyframes"]]
        rows.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(index), index["codec"], index["duration"] / index["timescale"], keys, media if keep_media else None))
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])), pa.binary()]
    return [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
