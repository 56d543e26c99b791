"""Array helpers on Arrow string columns: bytes, words and word shingles.

They work on the column's own UTF-8 buffer, in blocks of bounded size, so that
the cost is a few nanoseconds a byte and one long text needs no more memory
than many short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20  # bytes hashed at once
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: What is neither an ASCII letter or digit nor part of a longer character: ``[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]``.
SYMBOLS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers: dict[str, np.ndarray] = {}


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def bounded_batches(spark, most: int = 8 << 20) -> None:
    """Let Arrow batches hold at most ``most`` bytes of rows in this session, where its own bound is larger.

    Whole texts are large rows, and a batch is held several times over outside the
    heap.  The number of rows in a batch stays as the session has it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, None)
    if now is not None and not 0 < int(now.rstrip("b")) <= most:
        spark.conf.set(name, f"{most}b")


def spans(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes each; a longer row stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def power(kind: str, n: int) -> np.ndarray:
    got = _powers.get(kind)
    if got is None or len(got) < n:
        base = np.uint64(_BASE if kind == "up" else pow(_BASE, -1, 1 << 64))
        got = np.full(max(n, BLOCK + 1), base, np.uint64)
        got[0] = 1
        got = _powers[kind] = np.multiply.accumulate(got)
    return got


def _hash_block(raw: np.ndarray, breaks: np.ndarray, lower: bool, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words in ``raw``; ``breaks`` are row starts."""
    if lower:
        raw = _LOWER[raw]
    black = ~gap[raw]
    first, last = black.copy(), black.copy()
    first[1:] &= ~black[:-1]
    last[:-1] &= ~black[1:]
    inner = breaks[(breaks > 0) & (breaks < len(raw))]
    first[inner] = black[inner]
    last[inner - 1] = black[inner - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power("up", len(raw))[: len(raw)], out=total[1:])
    value = (total[end] - total[begin]) * power("down", len(raw))[begin]
    return mix(value ^ ((end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))), begin, end


def find_words(raw: np.ndarray, offsets: np.ndarray, lower: bool = True, gap: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words in order, with each one's row, first byte and end.

    Bytes that ``gap`` marks (white space: ``[\\x20\\x09-\\x0D]``) separate words.
    ``lower`` maps A-Z to a-z first.  A word's hash depends on its bytes alone.
    """
    hashes, at, to, pos, size = [], [], [], 0, len(raw)
    while pos < size:
        end = min(size, pos + BLOCK)
        if end < size:  # cut at white space or a row's start, wherever that comes next
            white = np.flatnonzero(gap[raw[pos:end]])
            row = offsets[np.searchsorted(offsets, end, "right") - 1]
            cut = max(pos + int(white[-1]) + 1 if len(white) else 0, int(row))
            while cut <= pos:
                more = min(size, end + BLOCK)
                white = np.flatnonzero(gap[raw[end:more]])
                later = offsets[np.searchsorted(offsets, end, "left")] if end < size else size
                cut = min(end + int(white[0]) + 1 if len(white) else size + 1, int(later), more if more == size else size + 1)
                if cut > size:
                    end, cut = more, pos
            end = cut
        low = np.searchsorted(offsets, pos, "left")
        high = np.searchsorted(offsets, end, "left")
        h, begin, stop = _hash_block(raw[pos:end], offsets[low:high] - pos, lower, gap)
        hashes.append(h)
        at.append(begin + pos)
        to.append(stop + pos)
        pos = end
    if not hashes:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    where = np.concatenate(at)
    return np.concatenate(hashes), np.searchsorted(offsets, where, "right") - 1, where, np.concatenate(to)


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` in order, and each one's row."""
    return find_words(raw, offsets, lower)[:2]


def joined(hashes: np.ndarray, words: int, salt: int = 0) -> np.ndarray:
    """The hash of the ``words`` hashes from each place on; rows are not looked at."""
    n = max(0, len(hashes) - words + 1)
    out = np.full(n, ((words + (salt << 16)) * 0x2545F4914F6CDD1D) & _MASK, np.uint64)
    for k in range(words):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + hashes[k : k + n])
    return out


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """For each row its sorted distinct hashes of ``words`` consecutive words.

    A row with fewer words has its whole sequence as its one shingle; a row
    without words has none.
    """
    hashes, row = word_hashes(raw, offsets)
    n = len(offsets) - 1
    bounds = np.searchsorted(row, np.arange(n + 1))
    counts = np.diff(bounds)

    def joined(start: np.ndarray, length: int) -> np.ndarray:
        out = np.full(len(start), (length * 0x2545F4914F6CDD1D) & _MASK, np.uint64)
        for k in range(length):
            out = mix(out * np.uint64(0x9FB21C651E98DF25) + hashes[start + k])
        return out

    full = joined(np.arange(max(0, len(hashes) - words + 1)), words)
    short = {c: joined(bounds[:-1][counts == c], c) for c in range(1, words)}
    seen = dict.fromkeys(short, 0)
    out = []
    for i in range(n):
        c = int(counts[i])
        if c >= words:
            out.append(np.unique(full[bounds[i] : bounds[i + 1] - words + 1]))
        elif c:
            out.append(short[c][seen[c] : seen[c] + 1])
            seen[c] += 1
        else:
            out.append(np.zeros(0, np.uint64))
    return out
