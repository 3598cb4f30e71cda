"""Hashes of words over whole batches of texts, with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
ODD = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)

_ORDINALS = np.arange(256)
SPACE = np.isin(_ORDINALS, [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
LOWER = np.where((_ORDINALS >= 65) & (_ORDINALS <= 90), _ORDINALS + 32, _ORDINALS).astype(np.uint8)
# ASCII letters and all bytes of other characters.
LETTER = ((_ORDINALS >= 97) & (_ORDINALS <= 122)) | ((_ORDINALS >= 65) & (_ORDINALS <= 90)) | (_ORDINALS >= 128)


@dataclass
class Texts:
    """Bytes of a batch of texts, one after another; ``offsets`` bound each."""

    data: np.ndarray
    offsets: np.ndarray

    @staticmethod
    def of(column: pa.Array) -> "Texts":
        """From an Arrow string column; a null text is empty."""
        column = column.cast(pa.large_string())
        if column.null_count:
            column = column.fill_null("")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        if not len(column) or offsets[-1] == offsets[0]:
            return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
        data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        return Texts(data, offsets - offsets[0])


@dataclass
class Words:
    """Words of a batch: first byte, length and hash, and where each text's words start."""

    starts: np.ndarray
    lengths: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray
    places: np.ndarray
    data: np.ndarray

    def prefixes(self, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of each word."""
        keep = np.where(self.places < size, self.data, np.uint64(0))
        return mix(np.add.reduceat(keep, self.runs)) if len(self.starts) else self.hashes

    @property
    def runs(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.lengths)[:-1]))


def words(texts: Texts, inside: np.ndarray) -> Words:
    """Runs of bytes for which ``inside`` holds, A-Z lower-cased, no run across two texts."""
    data, n = texts.data, len(texts.data)
    member = inside[data]
    first = member.copy()
    first[1:] &= ~member[:-1]
    heads = texts.offsets[:-1]
    heads = heads[heads < n]
    first[heads] = member[heads]
    starts = np.flatnonzero(first)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return Words(starts, starts, none, np.zeros(len(texts.offsets), np.int64), starts, none)
    at = np.flatnonzero(member)
    # Place of every byte in its word.
    run = np.searchsorted(at, starts)
    lengths = np.diff(np.append(run, len(at)))
    places = np.arange(len(at)) - np.repeat(run, lengths)
    powers = np.full(int(lengths.max()), _BASE)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    coded = BYTE_CODES[LOWER[data[at]]] * powers[places]
    hashes = mix(np.add.reduceat(coded, run))
    return Words(starts, lengths, hashes, np.searchsorted(starts, texts.offsets), places, coded)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbouring word hashes, order included."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += mix(hashes[k : k + n] * ODD[k])
    return mix(total)
