"""Hashed word and n-gram features of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes handled at once; longer texts are handled alone, whole.
CHUNK_BYTES = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_shuffle = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _shuffle.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Letters, digits and all bytes of code points beyond ASCII make words.
IN_WORD = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])
BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


class Rolling:
    """Values of any span of a byte sequence: prefix sums of value * base^i modulo 2^64, moved to 0."""

    _up = np.ones(1, np.uint64)
    _down = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> None:
        n = len(data)
        if len(Rolling._up) <= n:
            size = max(n + 1, 2 * len(Rolling._up))
            for name, step in (("_up", _BASE), ("_down", _INVERSE)):
                steps = np.full(size, step, np.uint64)
                steps[0] = 1
                setattr(Rolling, name, np.cumprod(steps))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[data] * Rolling._up[:n])])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * Rolling._down[starts])

    def all_spans(self, length: int) -> np.ndarray:
        return mixed((self.sums[length:] - self.sums[:-length]) * Rolling._down[: len(self.sums) - length])


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes of the texts joined by line ends, start of each text and the end)."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        if held and size + len(t) > limit:
            yield _joined(first, held)
            first, held, size = i, [], 0
        held.append(t)
        size += len(t) + 1
    if held:
        yield _joined(first, held)


def _joined(first: int, held: list[bytes]) -> tuple[int, np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in held])])
    return first, np.frombuffer(b"\n".join(held) + b"\n", np.uint8), starts


def edges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    steps = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
