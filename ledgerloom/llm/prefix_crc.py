"""CRC-32 of many substrings of one scan: running values at word borders, shifted and cancelled over GF(2)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np

_POLYNOMIAL = 0xEDB88320
#: Lengths up to which a shift is one look into a table of its own; longer ones are put together from powers of two.
_DIRECT = 256
#: Words, and bytes of one text, that are worked on at once.
WORDS_AT_ONCE, BYTES_AT_ONCE = 1 << 17, 1 << 20
#: Every byte that is no part of a word becomes a space, capital letters become small ones.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def _byte_table() -> np.ndarray:
    r = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        r = np.where(r & 1, (r >> 1) ^ np.uint32(_POLYNOMIAL), r >> 1)
    return r


_BYTE = _byte_table()


def _looked_up(table: np.ndarray, base: np.ndarray | int, value: np.ndarray) -> np.ndarray:
    """Image of 32-bit values under a linear map given by the images of their four bytes."""
    found = table[base + (value & np.uint32(255))]
    for k in (1, 2, 3):
        found ^= table[base + 256 * k + ((value >> np.uint32(8 * k)) & np.uint32(255))]
    return found


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    basis = (np.arange(256, dtype=np.uint32)[None, :] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]).ravel()
    direct = [basis]
    for _ in range(1, _DIRECT + 1):
        last = direct[-1]
        direct.append(_BYTE[last & np.uint32(255)] ^ (last >> np.uint32(8)))
    powers = [direct[1]]
    for _ in range(1, 40):
        powers.append(_looked_up(powers[-1], 0, powers[-1]))
    return np.concatenate(direct[:_DIRECT]), powers


_SHIFT, _POWERS = _tables()


def shifted(value: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A CRC moved past ``length`` bytes: what it adds to the CRC of everything up to there."""
    short = length < _DIRECT
    if short.all():
        return _looked_up(_SHIFT, length.astype(np.int64) * 1024, value)
    out = value.copy()
    out[short] = _looked_up(_SHIFT, length[short].astype(np.int64) * 1024, value[short])
    left, some = length[~short].astype(np.int64), value[~short]
    k = 0
    while left.any():
        odd = (left & 1).astype(bool)
        some[odd] = _looked_up(_POWERS[k], 0, some[odd])
        left, k = left >> 1, k + 1
    out[~short] = some
    return out


def _past_space(crc: np.ndarray) -> np.ndarray:
    r = ~crc
    return ~(_BYTE[(r ^ np.uint32(0x20)) & np.uint32(255)] ^ (r >> np.uint32(8)))


def _words(texts: Iterable[str]) -> Iterator[tuple[int, list[bytes]]]:
    """Words of every text with its number, in pieces of bounded size; texts without a word are left out."""
    for number, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES)
        if len(data) <= BYTES_AT_ONCE:
            yield number, data.split()
            continue
        start = 0
        while start < len(data):
            stop = data.find(b" ", start + BYTES_AT_ONCE)
            stop = len(data) if stop < 0 else stop
            yield number, data[start:stop].split()
            start = stop


def ngram_crcs(texts: Iterable[str], longest: int = 3) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """CRC-32 of every run of 1 to ``longest`` consecutive words, joined by one space.

    Each text is scanned once as its words with a space before each; the running CRC is kept at both ends of every
    word. A run from word i to word j has the CRC ``end(j) ^ shifted(start(i), bytes between)``: what came before i
    cancels out. Yields blocks of (number of the text of each run, its CRC, number of the text of each new word, words
    in the runs); blocks overlap by the words that later runs begin with.
    """
    crc, place = 0, 0
    held: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)]
    numbers: list[int] = []
    counts: list[int] = []
    ends: list[int] = []
    sizes: list[int] = []

    def block() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        nonlocal held, place
        owner = np.repeat(np.array(numbers, np.int64), counts)
        end = np.array(ends, np.uint32)
        stop = place + np.cumsum(np.array(sizes, np.int64) + 1)
        place = int(stop[-1])
        begin = stop - np.array(sizes, np.int64)
        before = np.empty_like(end)
        before[1:] = end[:-1]
        before[0] = first
        start = _past_space(before)
        old = len(held[0])
        owners, starts, begins = (np.concatenate(p) for p in zip(held, (owner, start, begin), strict=True))
        found, run, size = [], [], []
        for n in range(longest):
            # the run of n + 1 words that ends with a new word begins n words before it
            lo = max(old - n, 0)
            a = np.arange(lo, len(owners) - n)
            b = a + n - old
            same = owners[a] == owner[b]
            a, b = a[same], b[same]
            run.append(end[b] ^ shifted(starts[a], stop[b] - begins[a]))
            found.append(owner[b])
            size.append(np.full(len(a), n + 1, np.int64))
        held = [x[max(len(x) - longest + 1, 0):] for x in (owners, starts, begins)]
        return np.concatenate(found), np.concatenate(run), owner, np.concatenate(size)

    first = 0
    for number, words in _words(texts):
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at:at + WORDS_AT_ONCE]
            numbers.append(number)
            counts.append(len(some))
            ends += [crc := crc32(w, crc32(b" ", crc)) for w in some]
            sizes += map(len, some)
            if len(ends) >= WORDS_AT_ONCE:
                yield block()
                first, numbers, counts, ends, sizes = crc, [], [], [], []
    if ends:
        yield block()
