"""Whole texts of an Arrow batch as numpy arrays: bytes, words and hashes of words.

Used inside ``mapInArrow``. A word is a run of bytes outside 0x20 and 0x09 to 0x0D, which never cuts a
UTF-8 character.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Texts are worked on in chunks of about so many bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 1_000_000
CHUNK_ROWS = 60_000

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts as bytes, about ``size`` of them; a null text is empty."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
        start, total, held = 0, 0, []
        for row, value in enumerate(texts):
            data = value.as_py() or b""
            if held and (total + len(data) > size or len(held) >= CHUNK_ROWS):
                yield batch.slice(start, row - start), held
                start, total, held = row, 0, []
            held.append(data)
            total += len(data)
        if held:
            yield batch.slice(start), held


def lowered(texts: list[bytes]) -> list[bytes]:
    """A-Z lower-cased; bytes above 0x7F stay."""
    return [t.lower() for t in texts]


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


_MULTIPLIER = 0x9E3779B97F4A7C15


#: Powers of the multiplier are products of one of so many small ones and one of a multiple of it, so that a worker, which
#: outlives its task, keeps no table as long as the longest text.
_STEP = 2048


@lru_cache(maxsize=1)
def _powers(steps: int) -> tuple[np.ndarray, ...]:
    """Powers of an odd multiplier modulo 2^64: the first ``_STEP`` and those of ``steps`` multiples of it, then of its inverse."""

    def powers(base: int, n: int) -> np.ndarray:
        table = np.full(n, base % 2**64, dtype=np.uint64)
        table[0] = 1
        return np.cumprod(table, dtype=np.uint64)

    bases = _MULTIPLIER, pow(_MULTIPLIER, -1, 2**64)
    return tuple(powers(x, n) for base in bases for x, n in ((base, _STEP), (pow(base, _STEP, 2**64), steps)))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), all at once, from running sums of weighted bytes."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    low, high, inverse_low, inverse_high = _powers(max(1 << 10, 1 << (len(data) // _STEP).bit_length()))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    weighted = _byte_values()[data]
    whole = len(data) // _STEP * _STEP
    body = weighted[:whole].reshape(-1, _STEP)
    body *= low
    body *= high[: len(body), None]
    weighted[whole:] *= low[: len(data) - whole] * high[whole // _STEP]
    np.cumsum(weighted, out=sums[1:])
    inverses = inverse_low[starts % _STEP] * inverse_high[starts // _STEP]
    lengths = (ends - starts).astype(np.uint64)
    return mixed((sums[ends] - sums[starts]) * inverses + lengths * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """The words of several texts: spans in ``data``, the text of each, and the first word of each text."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts) + b"\n"
        self.data = np.frombuffer(joined, dtype=np.uint8)
        self.text_ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64)) - 1
        self.text_starts = np.concatenate([[0], self.text_ends[:-1] + 1]).astype(np.int64)
        inside = ~IS_SPACE[self.data]
        change = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
        # The data ends in white space, so starts and ends alternate.
        self.starts, self.ends = change[0::2], change[1::2]
        self.first = np.searchsorted(self.starts, np.concatenate([self.text_starts, [len(self.data)]])).astype(np.int64)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` hashes from each position on, order included; wrong for the last ones."""
    total = np.zeros(len(hashes), dtype=np.uint64)
    for k in range(width):
        part = hashes[k:] * np.uint64((2 * k + 1) * 0xA24BAED4963EE407 % 2**64 | 1)
        total[: len(part)] += mixed(part)
    return mixed(total)
