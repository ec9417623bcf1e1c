"""What a Python worker remembers of the words it has seen."""

from __future__ import annotations

import weakref
from collections.abc import Callable, Iterator
from sys import getsizeof
from typing import Any

import pyarrow as pa

BYTES = 96 << 20  # of all words that a worker remembers, for any operator
ENTRY = 80  # bytes of a dictionary's entry, about
ROWS = 512  # of whole texts that are made Python objects at a time

_all: weakref.WeakSet[WordCache] = weakref.WeakSet()


class WordCache(dict):
    """Word (bytes) to what ``make`` gives for it, a tuple, bytes or a number.

    A worker is used by one stage after the other and kept for long.  So that their memories do not add up, a stage that begins
    (:meth:`begin`) drops what others remember.  Half of ``BYTES`` may be new; then words not asked for since the last such
    moment go, and the others come back from the older half.
    """

    def __init__(self, make: Callable[[bytes], Any]):
        super().__init__()
        self.make, self.older, self.held = make, {}, 0
        _all.add(self)

    __hash__ = object.__hash__
    __eq__ = object.__eq__

    def begin(self) -> WordCache:
        for other in list(_all):
            if other is not self:
                other.forget()
        return self

    def forget(self) -> None:
        self.clear()
        self.older, self.held = {}, 0

    def __missing__(self, word: bytes) -> Any:
        value = self.older.pop(word, None)
        return self.keep(word, self.make(word) if value is None else value)

    def keep(self, word: bytes, value: Any) -> Any:
        """Remembers the value of a word that is not in the newer half, and returns it."""
        self.held += ENTRY + getsizeof(word) + getsizeof(value)
        if isinstance(value, tuple):
            self.held += sum(map(getsizeof, value))
        if self.held > BYTES // 2:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self[word] = value
        return value


def sliced(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that few whole texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
