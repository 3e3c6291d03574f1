"""Byte n-grams as 64-bit codes, and lookups of such codes, for models that score whole texts inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes that never occur in UTF-8, used before a text's start and at its end.
START, END = 0xFF, 0xFE


def segments(texts: list[bytes], depth: int, limit: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Every byte of every text with the ``depth`` bytes before it, in bounded pieces of about ``limit`` bytes.

    Yields (codes, owners, starts): codes hold depth + 1 bytes, the last one lowest; owners are the numbers of the
    texts in this piece, and starts are where their codes begin. Empty texts do not occur.
    """
    pad = bytes([START]) * depth
    parts: list[bytes] = []
    owners: list[int] = []
    sizes: list[int] = []
    total = 0
    for k, text in enumerate(texts):
        for at in range(0, len(text), limit):
            piece = text[at : at + limit]
            parts += [pad if at == 0 else (pad + text[max(0, at - depth) : at])[-depth:] if depth else b"", piece]
            owners.append(k)
            sizes.append(len(piece))
            total += len(piece)
            if total >= limit:
                yield _codes(parts, owners, sizes, depth)
                parts, owners, sizes, total = [], [], [], 0
    if owners:
        yield _codes(parts, owners, sizes, depth)


def _codes(parts: list[bytes], owners: list[int], sizes: list[int], depth: int):
    # The eight bytes up to each place are read as one number; those beyond ``depth`` are masked.
    buffer = bytes(7 - depth) + b"".join(parts)
    n = np.asarray(sizes, dtype=np.int64)
    starts = np.cumsum(n) - n
    codes = np.ndarray((len(buffer) - 7,), ">u8", buffer, 0, (1,)).astype(np.uint64)
    if depth < 7:
        codes &= low_bytes(depth + 1)
    # Codes that end in a text's padding are left out: after each text, the next one's depth bytes of padding.
    keep = np.ones(len(codes), dtype=bool)
    for k in range(depth):
        gaps = (starts + n + np.arange(len(n)) * depth + k)[:-1]
        keep[gaps] = False
    return codes[keep], np.asarray(owners), starts


class Lookup:
    """Places of 64-bit keys in the array that it was built from; -1 for others. Open addressing, all in numpy."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 2.5))))
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.zeros(1 << bits, dtype=np.uint64)
        self._at = np.full(1 << bits, -1, dtype=np.int32)
        todo = np.arange(len(keys), dtype=np.int32)
        slots = self._slots(keys)
        while len(todo):
            free = self._at[slots] < 0
            self._at[slots[free]] = todo[free]
            placed = self._at[slots] == todo
            todo, slots = todo[~placed], (slots[~placed] + 1) & self._mask
        full = self._at >= 0
        self._keys[full] = keys[self._at[full]]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        out = self._at[slots]
        wrong = np.flatnonzero((out >= 0) & (self._keys[slots] != keys))
        slots = slots[wrong]
        while len(wrong):
            slots = (slots + 1) & self._mask
            found = self._at[slots]
            out[wrong] = found
            more = (found >= 0) & (self._keys[slots] != keys[wrong])
            wrong, slots = wrong[more], slots[more]
        return out


def low_bytes(n: int) -> np.uint64:
    """Mask of the last ``n`` bytes of a code."""
    return np.uint64((1 << (8 * n)) - 1)
