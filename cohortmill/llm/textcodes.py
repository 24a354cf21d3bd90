"""Numpy helpers used inside tasks: words of many texts as 64-bit codes, without Python objects per word."""

import hashlib

import numpy as np

# Words are coded in pieces of about this many bytes; a longer text is cut at white space.
PIECE = 1 << 18
# Bytes of texts that are taken from an Arrow batch at once.
STRETCH = 1 << 21
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

# Stretches of more bytes are coded by a digest; a mask keeps the lowest bytes of a block.
LONG = 64
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
BASE, BASE2 = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and ``base ** -i`` modulo 2**64, for i below ``n`` at least."""
    held = _powers.get(base)
    if held is None or len(held[0]) < n:
        size = 1 << max(PIECE + 1024, n).bit_length()
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        held = _powers[base] = tuple(both)
    return held


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit codes over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(codes: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """One code for every run of ``width`` consecutive codes."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = powers(base, len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[:len(codes)], out=total[1:])
    return mix((total[width:] - total[:n]) * down[:n])


def edges(raw: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end in bytes that end in white space; ``gap`` marks the bytes between words."""
    edge = np.flatnonzero(np.diff(gap[raw], prepend=True))
    return edge[::2], edge[1::2]


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One code for each stretch of bytes: its blocks of eight bytes mixed in one after the other.

    Every step is one-to-one in the block, so stretches of equal length up to eight bytes never share a
    code; longer ones share one by chance only (64 bits).  Stretches beyond LONG bytes are digested.
    """
    size = ends - starts
    blocks = np.ndarray((len(raw) + 1,), "<u8", np.concatenate((raw, np.zeros(8, np.uint8))), strides=(1,))
    code = size.astype(np.uint64) * np.uint64(BASE2)
    left = np.arange(len(size))
    for at in range(0, LONG, 8):
        if at:
            left = left[size[left] > at]
        if not len(left):
            break
        part = blocks[starts[left] + at] & MASKS[np.minimum(size[left] - at, 8)]
        code[left] = mix((code[left] ^ part) * np.uint64(BASE) + np.uint64(BASE2))
    for i in np.flatnonzero(size > LONG).tolist():
        code[i] = int.from_bytes(hashlib.blake2b(raw[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return code


def _piece_codes(data: bytes, lower: bool, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and start offsets of the words of ``data``, which ends in white space."""
    raw = np.frombuffer(data, np.uint8)
    if lower:
        raw = LOWER[raw]
    starts, ends = edges(raw, gap)
    return hash_spans(raw, starts, ends), starts


def cuts(text: bytes, size: int | None = None):
    """Pieces of a long text, of ``size`` bytes (a PIECE), cut after white space."""
    at, size = 0, size or PIECE
    while len(text) - at > size:
        window = np.frombuffer(text, np.uint8, count=size, offset=at)
        gaps = np.flatnonzero(SPACE[window])
        if len(gaps):
            end = at + int(gaps[-1]) + 1
        else:  # a word longer than a piece
            end = at + size
            while end < len(text) and not SPACE[text[end]]:
                end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def word_codes(texts: list[bytes], lower: bool = False, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words ``[^\\x20\\x09-\\x0D]+`` and, per text, where its words begin (one more at the end).

    Another ``gap`` (bytes between words) must hold white space."""
    out, bounds, done, group, size = [], [np.zeros(1, np.int64)], 0, [], 0

    def flush():
        nonlocal done, group, size
        if group:
            codes, starts = _piece_codes(b"\n".join(group) + b"\n", lower, gap)
            ends = np.cumsum([len(t) + 1 for t in group])
            bounds.append(done + np.searchsorted(starts, ends))
            out.append(codes)
            done += len(codes)
        group, size = [], 0

    for t in texts:
        if len(t) > PIECE:
            flush()
            for piece in cuts(t):
                out.append(_piece_codes(piece + b"\n", lower, gap)[0])
                done += len(out[-1])
            bounds.append(np.array([done]))
        else:
            if size + len(t) > PIECE:
                flush()
            group.append(t)
            size += len(t) + 1
    flush()
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), np.concatenate(bounds).astype(np.int64)


def groups_of_texts(texts: list, limit: int = STRETCH):
    """Ranges (from, to) of ``texts`` with about ``limit`` bytes each."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= limit:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def stretches(column, limit: int = STRETCH):
    """Ranges (from, to) of an Arrow column of texts or bytes with about ``limit`` bytes each."""
    import pyarrow.compute as pc

    upto = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(upto):
        before = int(upto[at - 1]) if at else 0
        end = min(int(np.searchsorted(upto, before + limit)) + 1, len(upto))
        yield at, end
        at = end


def as_bytes(column) -> list[bytes]:
    """An Arrow text column as UTF-8 bytes; null is empty."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]
