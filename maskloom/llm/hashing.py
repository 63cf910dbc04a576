"""Hashes of words and character n-grams over many texts at once, with numpy."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[str, np.ndarray] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64; kept per process and grown on demand."""
    if len(_powers.get("up", ())) < size:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        length = max(size, 1 << 21)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(length, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:size], _powers["down"][:size]


def mixed(values: np.ndarray) -> np.ndarray:
    """A multiply-and-shift finish, so that low bits depend on all bits."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def word_hashes(texts: list[bytes], separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number, starts with a capital) of every word; ``separators`` marks the bytes between words.

    A word's hash is a polynomial of its bytes: differences of one running sum, scaled back by the word's
    position. All arithmetic is modulo 2**64.
    """
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = ~separators[joined]
    inside[-1] = False
    edges = np.diff(inside.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = _power_tables(len(joined) + 1)
    running = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * up[: len(joined)], out=running[1:])
    hashes = mixed((running[ends] - running[starts]) * down[starts])
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(first, starts, "right") - 1, starts


def gram_hashes(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every run of ``size`` bytes inside one text."""
    joined = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    lengths = np.array([len(t) for t in texts], np.int64)
    count = max(len(joined) - size + 1, 0)
    value = np.zeros(count, np.uint64)
    for place in range(size):
        value = value * _BASE + joined[place : place + count] + np.uint64(1)
    owner = np.repeat(np.arange(len(texts)), lengths)
    same = owner[:count] == owner[size - 1 : size - 1 + count] if count else np.zeros(0, bool)
    return mixed(value[same]), owner[:count][same]
