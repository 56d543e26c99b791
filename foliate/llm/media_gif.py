"""GIF columns: encode samples, decode LZW streams, render timed frames, colour histograms.

The decoder takes any GIF: variable code widths, clear codes (deferred ones too), the
code that is not yet in the table, interlacing, local palettes, transparency and
disposal.  The encoder writes compressed streams with growing tables, transparent samples
and every kind of disposal, so that each stored text exercises it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.textarrays import bounded_batches, spans, utf8

WIDTH, FRAME_ROWS = 192, 64
DELAY_CS = 10
BINS = 8
BATCH_BYTES = 2 << 20
DISPOSALS = (1, 3, 2)  # of frames in turn: stay, give way to what was before, cleared
_GREY = np.repeat(np.arange(256, dtype=np.uint8), 3).tobytes()


class Frame(NamedTuple):
    """A rendered frame: time shown, its own rectangle, and the whole canvas as RGBA."""

    delay_ms: int
    left: int
    top: int
    width: int
    height: int
    canvas: np.ndarray


def _blocks(data: bytes) -> bytes:
    """``data`` in sub-blocks of at most 255 bytes, with the terminator."""
    full = len(data) // 255
    body = np.empty((full, 256), np.uint8)
    body[:, 0] = 255
    body[:, 1:] = np.frombuffer(data, np.uint8, full * 255).reshape(full, 255)
    rest = data[full * 255 :]
    return body.tobytes() + (bytes([len(rest)]) + rest if rest else b"") + b"\0"


def _widths(index: np.ndarray, minimum: int) -> np.ndarray:
    """The bits of the code at each place after a clear code: one more whenever the table has outgrown them, 12 at most."""
    entries = np.minimum(index, 4096) + (1 << minimum) + 2
    return np.clip(np.ceil(np.log2(entries)).astype(np.int64), minimum + 1, 12)


@lru_cache(maxsize=16)
def _places(minimum: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits and first bit of each of the first 4096 codes after a clear code."""
    width = _widths(np.arange(4096), minimum)
    return width, np.cumsum(width) - width


def lzw_encode(samples: bytes, minimum: int = 8) -> bytes:
    """The code stream of samples below 2 ** minimum: known strings grow by a sample, and the table is cleared when it holds 4096."""
    clear = 1 << minimum
    codes, table, used = [clear], {}, clear + 2
    put, get, rest = codes.append, table.get, iter(samples)
    value = next(rest, None)
    for sample in rest:
        key = value << 8 | sample
        longer = get(key)
        if longer is not None:
            value = longer
            continue
        put(value)
        value = sample
        if used < 4096:
            table[key] = used
            used += 1
        else:
            put(clear)
            table.clear()
            used = clear + 2
    if value is not None:
        put(value)
    put(clear + 1)
    written = np.array(codes, np.int64)
    clears = np.flatnonzero(written == clear)
    at = np.arange(len(written))
    width = _widths(np.maximum(at - clears[np.maximum(np.searchsorted(clears, at) - 1, 0)] - 1, 0), minimum)
    first = np.cumsum(width) - width
    spread = written << (first & 7)  # of up to 19 bits, over three bytes
    size = -(-int(width.sum()) // 8)
    return sum(np.bincount((first >> 3) + k, spread >> 8 * k & 255, size + 3) for k in range(3))[:size].astype(np.uint8).tobytes()


def _strings(codes: np.ndarray, clear: int, count: int) -> np.ndarray:
    """The first ``count`` samples of the codes between two clear codes.

    The table's entry k is the string of code k and the sample after it, that is a
    stretch of the output.  So the length of a code's string follows from its entry's
    code, and each sample from an earlier one; both chains are followed by doubling.
    """
    at = np.arange(len(codes))
    entry = np.where(codes < clear, at, codes - clear - 2)  # a literal points at itself
    if ((codes >= clear) & (entry >= at)).any():
        raise ValueError("a code is not in the table")
    length, to = (codes >= clear).astype(np.int64), entry
    while (length[to] > 0).any():
        length, to = length + length[to], to[to]
    length += 1
    first = np.cumsum(length) - length
    use = int(np.searchsorted(first, count))
    total = int(first[use - 1] + length[use - 1]) if use else 0
    owner = np.repeat(np.arange(use), length[:use])
    source = np.arange(total) + (first[entry[:use]] - first[:use])[owner]
    out = codes[:use][owner]
    while True:
        copied = np.flatnonzero(out >= clear)
        if not len(copied):
            return out[:count].astype(np.uint8)
        out[copied] = out[source[copied]]
        source[copied] = source[source[copied]]


def lzw_decode(data: bytes, minimum: int, count: int) -> np.ndarray:
    """The first ``count`` samples of a code stream with the minimum code size given."""
    clear, out, size, bit = 1 << minimum, [], 0, 0
    held: list[np.ndarray] = []
    place = 0
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)]).astype(np.int64)
    while size < count:
        # up to 4096 codes whose widths follow from their place after the last clear code
        width, first = _places(minimum) if not place else (_places(minimum)[0][-1:].repeat(4096), np.arange(4096) * 12)
        most = int(np.searchsorted(first + width, 8 * len(data) - bit, "right"))
        width, first = width[:most], first[:most] + bit
        byte = first >> 3
        codes = (raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16) >> (first & 7) & (1 << width) - 1
        marks = np.flatnonzero((codes == clear) | (codes == clear + 1))
        n = int(marks[0]) if len(marks) else len(codes)
        held.append(codes[:n])
        if not len(marks) and len(codes):
            place, bit = place + n, int(first[-1] + width[-1])
            continue
        if place or n:
            out.append(_strings(np.concatenate(held) if place else held[-1], clear, count - size))
            size += len(out[-1])
        if not len(codes) or codes[n] != clear:
            break
        held, place, bit = [], 0, int(first[n] + width[n])
    return np.concatenate([np.zeros(0, np.uint8), *out])


def encode(samples: bytes, width: int = WIDTH, frame_rows: int = FRAME_ROWS) -> bytes:
    """A GIF of 8-bit grey samples: rows of ``width``, ``frame_rows`` of them in each timed frame.

    A frame after the first leaves out the samples that already show (as a
    transparent index that no sample has, if there is one).  Frames stay, give way to what was
    before, or are cleared, in turn.
    """
    rows = len(samples) // width
    canvas = min(rows, frame_rows)
    parts = [b"GIF89a", width.to_bytes(2, "little"), canvas.to_bytes(2, "little"), b"\xf7\0\0", _GREY]
    pixels = np.frombuffer(samples, np.uint8)
    shown = np.full(canvas * width, -1, np.int16)
    for n, top in enumerate(range(0, rows, frame_rows)):
        high = min(frame_rows, rows - top)
        index, clear = pixels[top * width : (top + high) * width], -1
        here, kind = shown[: len(index)], DISPOSALS[n % len(DISPOSALS)]
        same = here == index
        free = np.flatnonzero(np.bincount(index, minlength=256) == 0)
        if len(free) and same.any():
            clear = int(free[-1])
        stream = lzw_encode(index.tobytes() if clear < 0 else np.where(same, np.uint8(clear), index).tobytes())
        flags = kind << 2 | (clear >= 0)
        parts += [b"\x21\xf9\x04", bytes([flags]), DELAY_CS.to_bytes(2, "little"), bytes([max(clear, 0), 0]), b"\x2c\0\0\0\0", width.to_bytes(2, "little"), high.to_bytes(2, "little"), b"\0\x08", _blocks(stream)]
        if kind == 1:
            here[:] = index
        elif kind == 2:
            here[:] = -1
    return b"".join([*parts, b"\x3b"])


def _joined(data: bytes, at: int) -> tuple[bytes, int]:
    """The sub-blocks at ``at`` without their lengths, and where they end."""
    run = at
    while data[run] == 255:
        run += 256
    full = np.frombuffer(data, np.uint8, run - at, at).reshape(-1, 256)[:, 1:].tobytes() if run > at else b""
    parts = [full]
    while n := data[run]:
        parts.append(data[run + 1 : run + 1 + n])
        run += n + 1
    return b"".join(parts), run + 1


def _palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray | None, int]:
    if not flags & 0x80:
        return None, at
    n = 2 << (flags & 7)
    colours = np.full((256, 4), 255, np.uint8)
    colours[:, :3] = 0
    colours[:n, :3] = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
    return colours, at + 3 * n


def _rows_in_order(height: int) -> np.ndarray:
    """Where each stored row of an interlaced frame belongs."""
    return np.concatenate([np.arange(start, height, step) for start, step in ((0, 8), (4, 8), (2, 4), (1, 2))])


def frames(data: bytes) -> Iterator[Frame]:
    """Render the frames one after the other; memory holds one canvas and what disposal restores."""
    if data[:3] != b"GIF":
        raise ValueError("not a GIF")
    wide, high = int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little")
    shared, at = _palette(data, 13, data[10])
    canvas = np.zeros((high, wide, 4), np.uint8)
    delay, disposal, clear = 0, 0, -1
    while data[at] != 0x3B:
        kind = data[at]
        if kind == 0x21:
            if data[at + 1] == 0xF9:
                flags = data[at + 3]
                delay, disposal = int.from_bytes(data[at + 4 : at + 6], "little") * 10, flags >> 2 & 7
                clear = data[at + 6] if flags & 1 else -1
            at = _joined(data, at + 2)[1]
        elif kind == 0x2C:
            left, top, w, h = np.frombuffer(data, "<u2", 4, at + 1).tolist()
            flags = data[at + 9]
            own, at = _palette(data, at + 10, flags)
            stream, end = _joined(data, at + 1)
            index = lzw_decode(stream, data[at], w * h)
            index = np.concatenate([index, np.zeros(w * h - len(index), np.uint8)]).reshape(h, w)
            if flags & 0x40:
                straight = np.empty_like(index)
                straight[_rows_in_order(h)] = index
                index = straight
            colours = own if own is not None else shared
            if colours is None:
                raise ValueError("a frame has no palette")
            area = canvas[top : top + h, left : left + w]
            index = index[: area.shape[0], : area.shape[1]]
            kept = area.copy() if disposal == 3 else None
            if clear < 0:
                area[:] = colours[index]
            else:
                area[index != clear] = colours[index[index != clear]]
            yield Frame(delay, left, top, area.shape[1], area.shape[0], canvas)
            if disposal == 2:
                area[:] = 0
            elif kept is not None:
                area[:] = kept
            delay, disposal, clear, at = 0, 0, -1, end
        else:
            raise ValueError(f"unknown block {kind:#x}")


def histogram(canvas: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Counts of the red, green and blue values in ``bins`` equal ranges, of pixels that are not transparent."""
    step = 256 // bins
    seen = canvas.reshape(-1, 4)
    if not seen[:, 3].all():
        seen = seen[seen[:, 3] > 0]
    return np.concatenate([np.bincount(seen[:, c] // step, minlength=bins) for c in range(3)])


def padded(text: bytes, unit: int = WIDTH) -> bytes:
    """``text`` with blanks up to a positive multiple of ``unit``."""
    return text + b" " * (max(1, -(-len(text) // unit)) * unit - len(text))


def store_media(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, media): every text as a GIF.  Null counts as the empty text; keys are passed on."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            for i, j in spans(offsets, BATCH_BYTES):
                media = [encode(padded(raw[offsets[k] : offsets[k + 1]].tobytes())) for k in range(i, j)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(offsets[i : j + 1])), pa.array(media, pa.binary())], ["key", "n_bytes", "media"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text")).mapInArrow(run, f"key {kind}, n_bytes long, media binary")
    return out.withColumnRenamed("key", key)


def media_frames(media: DataFrame, key: str = "doc_id", column: str = "media") -> DataFrame:
    """One row a frame: key, frame, shown_at_ms, delay_ms, width, height, rgba, and histogram (red, green, blue bins).

    A null or broken medium has no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "frame", "shown_at_ms", "delay_ms", "width", "height", "rgba", "histogram"]
        for batch in batches:
            for row, data in enumerate(batch.column(1)):
                shown = 0
                try:
                    for n, f in enumerate(frames(data.as_py()) if data.is_valid else ()):
                        high, wide = f.canvas.shape[:2]
                        values = [[n], [shown], [f.delay_ms], [wide], [high], [f.canvas.tobytes()], [histogram(f.canvas).tolist()]]
                        kinds = [pa.int64()] * 5 + [pa.binary(), pa.list_(pa.int64())]
                        yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1), *map(pa.array, values, kinds)], names)
                        shown += f.delay_ms
                except (ValueError, IndexError):
                    continue

    kind = media.schema[key].dataType.simpleString()
    out = media.select(media[key].alias("key"), media[column].alias("media")).mapInArrow(run, f"key {kind}, frame long, shown_at_ms long, delay_ms long, width long, height long, rgba binary, histogram array<long>")
    return out.withColumnRenamed("key", key)


def _described(stored: bytes) -> tuple:
    """Payload size, digest and tail, frames, times shown and histogram of a GIF; None for each if it is broken."""
    sha, size, tail, total, shown = hashlib.sha256(), 0, b"", np.zeros(3 * BINS, np.int64), []
    time = 0
    try:
        for f in frames(stored):
            part = np.ascontiguousarray(f.canvas[f.top : f.top + f.height, f.left : f.left + f.width, 0]).tobytes()
            sha.update(part)
            size, tail = size + len(part), (tail + part)[-16:]
            total += histogram(f.canvas)
            shown.append(time)
            time += f.delay_ms
    except (ValueError, IndexError):
        return (None,) * 7
    feature = f"frames={len(shown)};ms={time};grey=" + ",".join(map(str, total[:BINS].tolist()))
    return size, sha.hexdigest(), zlib.crc32(tail), feature, len(shown), shown, total.tolist()


def media_digests(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """Decode each stored GIF and describe what was read back.

    Columns: key, n_bytes, payload_bytes, payload_sha256, tail_crc32 of the red channel of
    each frame's rectangle in order, media_bytes, media_sha256, feature, frames,
    shown_at_ms (a time for each frame) and histogram (red, green and blue bins
    over all frames).  A null medium has null in all but key and n_bytes; a broken one
    has its own size and digest and null for what would be read from it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["payload_bytes", "payload_sha256", "tail_crc32", "feature", "frames", "shown_at_ms", "histogram", "media_bytes", "media_sha256"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.string()]
        for batch in batches:
            rows = []
            for data in batch.column(2):
                stored = data.as_py()
                rows.append((None,) * 9 if stored is None else (*_described(stored), len(stored), hashlib.sha256(stored).hexdigest()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 9
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, columns, kinds)], ["key", "n_bytes", *names])

    kind = media.schema[key].dataType.simpleString()
    out = media.select(media[key].alias("key"), "n_bytes", "media").mapInArrow(run, f"key {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, feature string, frames long, shown_at_ms array<long>, histogram array<long>, media_bytes long, media_sha256 string")
    return out.withColumnRenamed("key", key)


def op1_media_gif(spark, sf_dir: str) -> DataFrame:
    """Every document's text stored as a GIF, read back and described."""
    return media_digests(store_media(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
