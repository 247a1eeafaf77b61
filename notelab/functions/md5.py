"""MD5 of many short messages at once, as numpy columns.  Spark's ``md5`` gives the
same digests; this is for where a job needs millions of numbers from them and not the
texts."""

from __future__ import annotations

import numpy as np

MAX_BYTES = 55  # what one block of the algorithm holds
_SHIFTS = np.array([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], np.uint32)
_ADDED = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0 ** 32).astype(np.uint32)
_START = np.array([0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476], np.uint32)


def first_words(messages: np.ndarray, length: int) -> np.ndarray:
    """The number that the first eight hexadecimal digits of each digest spell.
    messages: rows of 64 bytes, of which the first ``length`` are the message."""
    if length > MAX_BYTES:
        raise ValueError(f"messages of more than {MAX_BYTES} bytes")
    padded = messages.copy()
    padded[:, length:] = 0
    padded[:, length] = 0x80
    padded[:, 56], padded[:, 57] = 8 * length % 256, 8 * length // 256
    words = np.ascontiguousarray(padded.view("<u4").T)
    a, b, c, d = (np.full(len(messages), x, np.uint32) for x in _START)
    for k in range(64):
        if k < 16:
            f, g = d ^ (b & (c ^ d)), k
        elif k < 32:
            f, g = c ^ (d & (b ^ c)), (5 * k + 1) % 16
        elif k < 48:
            f, g = b ^ c ^ d, (3 * k + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * k % 16
        f = f + a
        f += words[g]
        f += _ADDED[k]
        left = _SHIFTS[k // 16, k % 4]
        a, d, c, b = d, c, b, b + (f << left | f >> (np.uint32(32) - left))
    return (a + _START[0]).byteswap().astype(np.int64)


def numbered(prefix: bytes, first: int, last: int) -> np.ndarray:
    """``first_words`` of ``prefix`` followed by each number from ``first`` to ``last``
    in decimal."""
    out = []
    while first <= last:
        digits = len(str(first))
        upto = min(last, 10 ** digits - 1)
        i = np.arange(first, upto + 1, dtype=np.int64)
        messages = np.zeros((len(i), 64), np.uint8)
        messages[:, :len(prefix)] = np.frombuffer(prefix, np.uint8)
        end = len(prefix) + digits
        if end <= MAX_BYTES:
            for at in range(end - 1, len(prefix) - 1, -1):
                i, digit = np.divmod(i, 10)
                messages[:, at] = digit + ord("0")
        out.append(first_words(messages, end))
        first = upto + 1
    return np.concatenate([np.zeros(0, np.int64), *out])
