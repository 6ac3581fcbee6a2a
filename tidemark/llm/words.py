"""Words of many texts at once: numbered in Arrow, so that Python meets each distinct word of a chunk once."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that a Memo holds before it starts anew, and what an entry takes beside its word and its values.
MEMO_BYTES = 64 << 20
ENTRY_BYTES = 200

#: Words whose parts are known without a pattern: these letters, and perhaps one of these signs at the end.
PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
PLAIN_TAIL = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]$"


def numbered(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of lists of words: a number for each word, the place where each list begins (and the last ends), the distinct words."""
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    found = lists.flatten().dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), starts, found.dictionary


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The same of the words between ASCII white space in each text; no word is empty."""
    codes, starts, words = numbered(pc.ascii_split_whitespace(texts))
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:
        stays = codes != empty
        starts = np.concatenate([[0], np.cumsum(stays)])[starts]
        codes = codes[stays]
    return codes, starts, words


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of all runs, one after the other; a run begins at its start and has its size."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def run_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of values between each start and the next, 0 where a run is empty."""
    out = np.zeros((len(starts) - 1, *values.shape[1:]))
    filled = np.flatnonzero(np.diff(starts))
    if len(filled):
        out[filled] = np.add.reduceat(values, starts[filled], axis=0)
    return out


class Memo:
    """A run of values for each word, made once by `make` and kept between chunks, up to a number of bytes."""

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], dtype: np.dtype, limit: int = MEMO_BYTES):
        self.make, self.dtype, self.limit = make, np.dtype(dtype), limit
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.flat, self.ends = np.zeros(1024, self.dtype), np.zeros(1025, np.int64)
        self.bytes = 0

    @staticmethod
    def _room(held: np.ndarray, size: int) -> np.ndarray:
        if size <= len(held):
            return held
        more = np.zeros(max(size, len(held) * 3 // 2), held.dtype)
        more[: len(held)] = held
        return more

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the run in `flat` of each of some distinct words; they hold until the next call."""
        if self.bytes > self.limit:
            self.forget()
        listed, at = words.to_numpy(zero_copy_only=False).tolist(), self.at
        found = list(map(at.get, listed))
        new = [w for w, place in zip(listed, found, strict=True) if place is None]
        if new:
            values, sizes = self.make(new)
            n, end = len(at), int(self.ends[len(at)])
            self.flat = self._room(self.flat, end + len(values))
            self.flat[end : end + len(values)] = values
            self.ends = self._room(self.ends, n + len(new) + 1)
            self.ends[n + 1 : n + len(new) + 1] = end + np.cumsum(sizes)
            at.update(zip(new, range(n, n + len(new)), strict=True))
            self.bytes += sum(map(len, new)) + len(new) * ENTRY_BYTES + values.nbytes
            more = iter(range(n, n + len(new)))
            found = [next(more) if place is None else place for place in found]
        rows = np.array(found, np.int64)
        return self.ends[rows], self.ends[rows + 1] - self.ends[rows]


_held: dict[Any, Any] = {}


def hold(key: Any = None, make: Callable[[], Any] | None = None) -> Any:
    """What `make` gives, kept by the worker between tasks for a key. A worker keeps one such thing: another key, or none, drops it."""
    if key not in _held:
        _held.clear()
        if make is not None:
            _held[key] = make()
    return _held.get(key)


def release() -> None:
    """Gives memory that nothing uses any more back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)
