"""The first 32 bits of md5(key|i) for runs of numbers i, many at a time: what SQL's md5 says, without a row for each number."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa

Word = np.ndarray | int
#: Hashes at a time; the arrays of a step stay in a core's cache.
ROLLS = 25_000
#: Numbers that differ in their last five digits only; a whole number of ROLLS.
SPAN = 10**5
#: Fewer numbers of a span than these are hashed together with other keys'.
LEAST = 4096
_SHIFTS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_WORDS = [*range(16), *((5 * k + 1) % 16 for k in range(16)), *((3 * k + 5) % 16 for k in range(16)), *(7 * k % 16 for k in range(16))]
_SINES = [int(abs(math.sin(k + 1)) * 2**32) for k in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_MASK = 0xFFFFFFFF


def _mixed(k: int, a: Word, b: Word, c: Word, d: Word, w: Word) -> Word:
    """What step k makes, where registers or words may be one number for all."""
    if k < 16:
        f = d ^ (b & (c ^ d))
    elif k < 32:
        f = c ^ (d & (b ^ c))
    elif k < 48:
        f = b ^ c ^ d
    else:
        f = c ^ (b | (d ^ _MASK))
    fixed = [x for x in (a, f, w, _SINES[k]) if isinstance(x, int)]
    a = sum((x for x in (a, f, w) if not isinstance(x, int)), sum(fixed) & _MASK) & _MASK
    return ((a << _SHIFTS[k] & _MASK | a >> 32 - _SHIFTS[k]) + b) & _MASK


def _steps(state: Sequence[Word], words: list[Word], n: int = 64) -> tuple[Word, Word, Word, Word]:
    """The registers after n of MD5's steps on a block of 16 words, each an array or one number for all."""
    a, b, c, d = (x if isinstance(x, int) else x.copy() for x in state)
    f = None
    for k in range(n):
        w = words[_WORDS[k]]
        if f is None:
            if any(isinstance(x, int) for x in (a, b, c, d)):
                a, b, c, d = d, _mixed(k, a, b, c, d, w), b, c
                continue
            f, x = np.empty_like(a), np.empty_like(a)
        if k < 16:
            np.bitwise_xor(c, d, f)
            np.bitwise_and(f, b, f)
            np.bitwise_xor(f, d, f)
        elif k < 32:
            np.bitwise_xor(b, c, f)
            np.bitwise_and(f, d, f)
            np.bitwise_xor(f, c, f)
        elif k < 48 and k % 2 == 0:
            np.bitwise_xor(b, c, x)  # the next step's c and d
            np.bitwise_xor(x, d, f)
        elif k < 48:
            np.bitwise_xor(b, x, f)
        else:
            np.bitwise_not(d, f)
            np.bitwise_or(f, b, f)
            np.bitwise_xor(f, c, f)
        np.add(a, f, a)
        if isinstance(w, int):
            np.add(a, np.uint32((_SINES[k] + w) & _MASK), a)
        else:
            np.add(a, w, a)
            np.add(a, np.uint32(_SINES[k]), a)
        np.left_shift(a, np.uint32(_SHIFTS[k]), f)
        np.right_shift(a, np.uint32(32 - _SHIFTS[k]), a)
        np.bitwise_or(a, f, a)
        np.add(a, b, a)
        a, b, c, d = d, a, b, c
    return a, b, c, d


def _first_bits(words: list[Word]) -> np.ndarray:
    """The first 32 bits of the MD5 of a padded message: the last three steps don't touch them."""
    state: Sequence[Word] = _START
    for lo in range(0, len(words) - 16, 16):
        state = [(x + y) & _MASK for x, y in zip(state, _steps(state, words[lo : lo + 16]), strict=True)]
    return (_steps(state, words[-16:], 61)[1] + state[0]).byteswap()


def _padded(texts: list[bytes]) -> np.ndarray:
    """A row of words for each of some texts of one length, as MD5 pads them."""
    n = len(texts[0])
    size = 64 * ((n + 8) // 64 + 1)
    tail = b"\x80" + bytes(size - n - 9) + (8 * n).to_bytes(8, "little")
    return np.frombuffer(b"".join(t + tail for t in texts), "<u4").reshape(len(texts), size // 4)


def first_bits(keys: list[bytes], which: np.ndarray, numbers: np.ndarray, digits: int) -> np.ndarray:
    """The first 32 bits of md5(keys[which] | numbers), keys of one length, numbers of so many digits."""
    at = len(keys[0]) + 1
    fixed = _padded([k + b"|" + b"0" * digits for k in keys])
    words: list[Word] = [int(w[0]) if (w == w[0]).all() else w[which] for w in fixed.T]
    for place in range(at + digits - 1, at - 1, -1):
        more = numbers // np.uint64(10)
        digit = (numbers - more * np.uint64(10)).astype(np.uint32) << np.uint32(8 * (place % 4))
        w = words[place // 4]
        words[place // 4] = digit + np.uint32(w) if isinstance(w, int) else w + digit
        numbers = more
    return _first_bits(words)


@cache
def _last_digits(place: int, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """What the last digits, at most five, of 0 to SPAN - 1, the first at this byte of a word, add to that word and the next."""
    both, all_ = np.zeros((2, SPAN), np.uint32), np.arange(SPAN, dtype=np.uint32)
    for k in range(digits):
        at = place + k
        both[at // 4] += all_ // np.uint32(10 ** (digits - 1 - k)) % np.uint32(10) << np.uint32(8 * (at % 4))
    return both[0], both[1]


def run_below(key: bytes, first: int, last: int, limit: int) -> int:
    """How many i of first <= i <= last, of one number of digits and equal but for the last five, have first_bits below the limit.

    All but two words are one number for all, and what MD5 makes of these alone is made once.
    """
    number = str(first)
    text = key + b"|" + number[:-5].encode()
    digits = min(len(number), 5)
    words: list[Word] = _padded([text + b"0" * digits])[0].tolist()
    for k, table in enumerate(_last_digits(len(text) % 4, digits), len(text) // 4):
        words[k] = table[first % SPAN : last % SPAN + 1] + np.uint32(words[k])
    return int(np.count_nonzero(_first_bits(words) < limit))


def count_below(keys: list[bytes], first: list[int], last: list[int], limit: np.ndarray) -> np.ndarray:
    """For each key how many i of first <= i <= last have first_bits below its limit; first >= 1."""
    spans: dict[tuple[int, int], list[tuple[int, int, int]]] = defaultdict(list)
    out = np.zeros(len(keys), np.int64)
    for k, (lo, hi) in enumerate(zip(first, last, strict=True)):
        while lo <= hi:
            stop = min(hi + 1, 10 ** len(str(lo)), lo - lo % ROLLS + ROLLS)
            if stop - lo >= LEAST:
                out[k] += run_below(keys[k], lo, stop - 1, int(limit[k]))
            else:
                spans[len(keys[k]), len(str(lo))].append((k, lo, stop))
            lo = stop

    def flush(some: list[tuple[int, int, int]], digits: int) -> None:
        which = np.repeat(np.arange(len(some)), [hi - lo for _, lo, hi in some])
        numbers = np.concatenate([np.arange(lo, hi, dtype=np.uint64) for _, lo, hi in some])
        mine = np.array([k for k, _, _ in some])
        hit = first_bits([keys[k] for k in mine], which, numbers, digits) < limit[mine][which]
        np.add.at(out, mine, np.bincount(which, hit, len(some)).astype(np.int64))

    for (_, digits), all_ in spans.items():
        some, n = [], 0
        for span in all_:
            some.append(span)
            n += span[2] - span[1]
            if n >= ROLLS:
                flush(some, digits)
                some, n = [], 0
        if some:
            flush(some, digits)
    return out


def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, first, last, limit, ...) with the count of their numbers below the limit as v in place of these four."""
    for batch in batches:
        key, first, last = (batch.column(c).to_pylist() for c in ("key", "first", "last"))
        n = count_below([k.encode() for k in key], first, last, batch.column("limit").to_numpy())
        yield batch.drop_columns(["key", "first", "last", "limit"]).append_column("v", pa.array(n, pa.int64()))
