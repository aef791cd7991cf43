"""Arrow and numpy views of text columns, shared by the operators."""

from __future__ import annotations

import ctypes
from functools import cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
#: For work on words: numbers of eight bytes for every byte of a block make some 50 MB less
#: a worker than ``BLOCK_BYTES`` does.
WORD_BLOCK = 1 << 18
U64 = np.uint64
#: Odd multiplier of the rolling hash and its inverse modulo 2**64.
_R = 0x9E3779B97F4A7C15
_R_INV = pow(_R, -1, 1 << 64)
_TABLE = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
#: Bytes 0x20 and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


_KEPT: dict[str, object] = {}


@cache
def _trim():
    """The C library's call that returns free pages, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


def give_back() -> None:
    """Return memory that a worker has freed, and the tables that a task can make anew:
    workers stay for later stages, and what they hold counts against the executor."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    _trim()(0)


def worker_kept(name: str | None, make=None):
    """An object that a worker process keeps from task to task. Workers are reused by
    later stages, so what another kind of task has kept is dropped."""
    for other in [k for k in _KEPT if k != name]:
        del _KEPT[other]
    if name is not None and name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT.get(name)


def small_batches(batches, column: str, limit: int = BLOCK_BYTES, keep: str | None = None):
    """Cut record batches so that one slice holds about ``limit`` bytes of a string
    column (a longer text makes a slice of its own): a task's memory is bounded by
    the slice and the longest text, not by the batch the reader chose. ``keep`` names
    what the task wants to find kept (see ``worker_kept``)."""
    if keep is None:
        worker_kept(None)
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(lengths(batch.column(column)))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
    give_back()


def _buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary column; NULL has length 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_string_view(col.type) or not (pa.types.is_large_string(col.type) or pa.types.is_string(col.type)):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offs - offs[0], raw[offs[0] : offs[-1]]


def lengths(col: pa.Array) -> np.ndarray:
    return np.diff(_buffers(col)[0])


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values (wraps around by design)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: 0 white space, 1 letters, digits and all bytes of other scripts, 2 the rest of ASCII.
KIND = np.array([0 if SPACE[b] else 1 if b >= 128 or chr(b).isalnum() else 2 for b in range(256)], np.uint8)


def words(col: pa.Array, lower: bool = True, split_marks: bool = False, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of each text, A-Z lower-cased,
    and for each text the index of its first word (length + 1 entries). With
    ``split_marks`` a run of punctuation is a word of its own; ``inside`` names the
    bytes of other words (256 flags, upper and lower case alike).

    Works on the column's bytes: a word's hash is a difference of prefix sums, so
    no Python string is made."""
    offs, raw = _buffers(col)
    low = LOWER[raw] if lower else raw
    inside = ~SPACE[low] if inside is None else inside[low]
    first = np.zeros(len(low) + 1, bool)
    first[offs[offs < len(low)]] = True
    first = first[: len(low)]
    kind = KIND[low] if split_marks else inside
    edge = (kind[1:] != kind[:-1]) | first[1:]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= edge
    ends[:-1] &= edge
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    with np.errstate(over="ignore"):
        power = _powers(len(low) + 1)
        sums = np.zeros(len(low) + 1, U64)
        np.cumsum(_TABLE[low] * power[:-1], out=sums[1:])
        h = (sums[stop] - sums[start]) * _powers(len(low) + 1, True)[start]
        h = mix(h + U64(0x632BE59BD9B4E019) * (stop - start).astype(U64))
    return h, np.searchsorted(start, offs)


_POWERS: dict[bool, np.ndarray] = {}


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    have = _POWERS.get(inverse)
    if have is not None and len(have) >= n:
        return have[:n]
    size = 1 << max(n - 1, (1 << 18) - 1).bit_length()  # as much as the blocks asked for so far need
    step = np.full(size, _R_INV if inverse else _R, U64)
    step[0] = 1
    with np.errstate(over="ignore"):
        have = np.cumprod(step)
    if size <= 2 * BLOCK_BYTES:  # a longer text's table isn't kept
        _POWERS[inverse] = have
    return have[:n]
