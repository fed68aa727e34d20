"""A bounded table of distinct chunks of text, for work that depends on the chunk alone."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa

_HELD: dict[Hashable, object] = {}


def for_worker(key: Hashable, make: Callable[[], object]):
    """What ``make`` gives, kept by this worker process for its next tasks until another stage's is asked for.

    A worker serves one stage after another, and the tables of finished ones would add up.
    """
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Forget what this worker process keeps for a stage that has ended."""
    if _HELD:
        _HELD.clear()
        gc.collect()
    give_back()


def give_back() -> None:
    """Return freed memory to the system, which the allocators would keep for this process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function of batches, giving freed memory back when it ends: an idle worker should hold little."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


class ChunkTable(dict):
    """chunk -> ``work(chunk)``, worked out when first asked for.

    It holds ``entries`` chunks of ``longest`` characters at most. A chunk beyond that is worked out
    each time it comes, and a full table starts anew, so memory is bounded and results are the same.
    """

    def __init__(self, work: Callable, entries: int = 200_000, longest: int = 64):
        super().__init__()
        self.work, self.entries, self.longest = work, entries, longest

    def __missing__(self, chunk: str):
        value = self.work(chunk)
        if len(chunk) <= self.longest:
            if len(self) >= self.entries:
                self.clear()
            self[chunk] = value
        return value
