"""SHA-256 that can be put down and taken up again, in another process too."""

from __future__ import annotations

import ctypes
import ctypes.util
import hashlib
import struct
from functools import cache
from math import isqrt

#: A digest begun: eight words, bytes taken in, the bytes that fill no block of 64 yet.
State = tuple[tuple[int, ...], int, bytes]
MASK = 0xFFFFFFFF


class _Context(ctypes.Structure):
    """SHA256_CTX of OpenSSL."""

    _fields_ = [("h", ctypes.c_uint32 * 8), ("low", ctypes.c_uint32), ("high", ctypes.c_uint32), ("data", ctypes.c_ubyte * 64), ("num", ctypes.c_uint), ("md_len", ctypes.c_uint)]


@cache
def _tables() -> tuple[tuple[int, ...], tuple[int, ...]]:
    """(first words, constants of the rounds): the fractions of the square and cube roots of the first primes."""
    primes = [p for p in range(2, 312) if all(p % d for d in range(2, isqrt(p) + 1))]

    def cube_root(n: int) -> int:
        lo, hi = 0, 1 << 40
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if mid**3 <= n else (lo, mid - 1)
        return lo

    return tuple(isqrt(p << 64) & MASK for p in primes[:8]), tuple(cube_root(p << 96) & MASK for p in primes)


def start() -> State:
    return _tables()[0], 0, b""


def _block(h: tuple[int, ...], block: bytes) -> tuple[int, ...]:
    w = list(struct.unpack(">16I", block))
    for i in range(16, 64):
        x, y = w[i - 15], w[i - 2]
        x, y = x | x << 32, y | y << 32
        w.append((w[i - 16] + w[i - 7] + (((x >> 7) ^ (x >> 18)) & MASK ^ (w[i - 15] >> 3)) + (((y >> 17) ^ (y >> 19)) & MASK ^ (w[i - 2] >> 10))) & MASK)
    a, b, c, d, e, f, g, k = h
    for r, word in zip(_tables()[1], w, strict=True):
        x, y = e | e << 32, a | a << 32
        one = k + (((x >> 6) ^ (x >> 11) ^ (x >> 25)) & MASK) + (e & f ^ ~e & g) + r + word
        two = (((y >> 2) ^ (y >> 13) ^ (y >> 22)) & MASK) + (a & b ^ a & c ^ b & c)
        a, b, c, d, e, f, g, k = (one + two) & MASK, a, b, c, (d + one) & MASK, e, f, g
    return tuple((x + y) & MASK for x, y in zip(h, (a, b, c, d, e, f, g, k), strict=True))


class Plain:
    """Anywhere, but slow: a fifth of a megabyte a second."""

    def __init__(self, state: State) -> None:
        self.h, self.n, self.rest = state

    def update(self, data: bytes) -> None:
        self.n += len(data)
        data = self.rest + data
        whole = len(data) // 64 * 64
        for i in range(0, whole, 64):
            self.h = _block(self.h, data[i : i + 64])
        self.rest = data[whole:]

    def state(self) -> State:
        return self.h, self.n, self.rest


class Native:
    """By the OpenSSL that hashlib is linked to, whose context can be read and set; hashlib's objects hide it."""

    def __init__(self, state: State, library: ctypes.CDLL | None = None) -> None:
        self.library, self.c = library or _library(), _Context()
        self.library.SHA256_Init(ctypes.byref(self.c))
        h, n, rest = state
        self.c.h[:] = h
        self.c.low, self.c.high, self.c.num = (n * 8) & MASK, n >> 29, len(rest)
        self.c.data[: len(rest)] = rest

    def update(self, data: bytes) -> None:
        self.library.SHA256_Update(ctypes.byref(self.c), data, len(data))

    def state(self) -> State:
        return tuple(self.c.h), (self.c.high << 32 | self.c.low) // 8, bytes(self.c.data[: self.c.num])


@cache
def _library() -> ctypes.CDLL | None:
    """OpenSSL, where it has these functions and they give hashlib's digest over a cut."""
    import _hashlib

    for name in (getattr(_hashlib, "__file__", None), ctypes.util.find_library("crypto")):
        try:
            found = ctypes.CDLL(name)
            for f in (found.SHA256_Init, found.SHA256_Update):
                f.restype = ctypes.c_int
            found.SHA256_Init.argtypes = [ctypes.c_void_p]
            found.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
            begun = Native(start(), found)
            begun.update(b"ab" * 70)
            after = Native(begun.state(), found)
            after.update(b"c" * 70)
            if hexdigest(after.state()) == hashlib.sha256(b"ab" * 70 + b"c" * 70).hexdigest():
                return found
        except (OSError, AttributeError):
            continue
    return None


def resumed(state: State) -> Native | Plain:
    return Native(state) if _library() else Plain(state)


def hexdigest(state: State) -> str:
    """The digest of what a state has taken in; by Plain, as it is a block or two."""
    h, n, rest = state
    end = Plain(state)
    end.update(b"\x80" + b"\0" * ((55 - len(rest)) % 64) + struct.pack(">Q", (n * 8) & (1 << 64) - 1))
    return struct.pack(">8I", *end.h).hex()
