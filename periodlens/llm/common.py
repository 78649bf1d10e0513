"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(modulus: int, remainder: int, key: str = "doc_id") -> Column:
    """True where crc32 of the key's text has this remainder; false for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def sliced(batch: pa.RecordBatch, limit: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` of about ``limit`` bytes, so that what is made of them stays small; one part at least."""
    rows = max(1, batch.num_rows // max(1, -(-batch.nbytes // limit)))
    for at in range(0, max(1, batch.num_rows), rows):
        yield batch.slice(at, rows)


_kept: dict[Any, Any] = {}


def kept_for(owner: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept in this Python worker until a partition of another owner begins."""
    if owner not in _kept:
        _kept.clear()
        _kept[owner] = make()
    return _kept[owner]


def release(owner: Any = None) -> None:
    """Give memory of earlier partitions back to the system; what is kept for ``owner`` stays.

    Spark uses its Python workers again for later stages, so what one stage
    leaves would stand beside what the next one needs.
    """
    if owner not in _kept:
        _kept.clear()
    _powers.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``function`` for ``mapInArrow``, with memory given back before and after its partition."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from function(batches)
        release()

    return apply


def with_columns_from_arrow(
    df: DataFrame, added: T.StructType, function: Callable[[pa.RecordBatch], list[pa.Array]], owner: Any = None
) -> DataFrame:
    """Run ``function`` on slices of the Arrow batches and put its arrays beside their columns.

    Columns of ``df`` that bear one of the added names are replaced. What the
    function keeps for ``owner`` serves all its partitions in a worker.
    """
    kept = df.drop(*added.names)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(owner)
        for batch in (part for whole in batches for part in sliced(whole)):
            arrays = function(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *added.names])
        release(owner)

    return kept.mapInArrow(apply, T.StructType([*kept.schema.fields, *added.fields]))


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; a null counts as empty."""
    return [b"" if value is None else value for value in column.cast(pa.binary()).to_pylist()]


def chunks_by_size(texts: list[bytes], limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together; a longer text comes alone."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if i > first and held + len(text) > limit:
            yield first, i
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


# --- hashing of words in whole batches ------------------------------------------------------------------------------

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_powers: dict[str, np.ndarray] = {}


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < size:
        length = 1 << max(16, (size - 1).bit_length())
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            steps = np.full(length, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers that scatters all bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _hash_piece(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and last two bytes (as one number) of each word of ``data``; words also end at ``cuts``."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint16)
    solid = ~_IS_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    cuts = cuts[cuts < len(data)]
    begins[cuts] = solid[cuts]
    stops = np.zeros(len(data) + 1, dtype=bool)
    stops[1:-1] = solid[:-1] & ~solid[1:]
    stops[-1] = solid[-1]
    inner = cuts[cuts > 0]
    stops[inner] = solid[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    up, down = _power_table(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    lower = _LOWER[data]
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    endings = lower[np.maximum(ends - 2, starts)].astype(np.uint16) << 8 | lower[ends - 1]
    return mix64(hashes + (ends - starts).astype(np.uint64)), starts, endings


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes between ``starts`` and ``ends``; equal bytes have equal hashes, wherever they stand."""
    up, down = _power_table(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hash_words(texts: list[bytes], limit: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z lower-cased, and where each text's words begin.

    Words are runs of bytes outside 0x20 and 0x09-0x0D. The second array has
    one more entry than there are texts. Memory beside the result is bounded
    by ``limit`` and the longest single word.
    """
    return hash_words_and_endings(texts, limit)[:2]


def hash_words_and_endings(texts: list[bytes], limit: int = 1 << 21) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``hash_words``, and the last two bytes of each word as one number."""
    hashes, endings, counts = [], [], np.zeros(len(texts) + 1, dtype=np.int64)
    for first, last in chunks_by_size(texts, limit):
        if last - first > 1 or len(texts[first]) <= limit:
            data = np.frombuffer(b"".join(texts[first:last]), dtype=np.uint8)
            bounds = np.cumsum([0, *map(len, texts[first:last])])
            found, starts, last_bytes = _hash_piece(data, bounds[:-1])
            hashes.append(found)
            endings.append(last_bytes)
            counts[first + 1 : last + 1] = np.diff(np.searchsorted(starts, bounds))
            continue
        whole, at = np.frombuffer(texts[first], dtype=np.uint8), 0
        while at < len(whole):
            end = min(at + limit, len(whole))
            while end < len(whole) and not _IS_SPACE[whole[end]]:
                ahead = np.flatnonzero(_IS_SPACE[whole[end : end + limit]])
                end = end + int(ahead[0]) if len(ahead) else min(end + limit, len(whole))
            found, _, last_bytes = _hash_piece(whole[at:end], np.zeros(1, np.int64))
            hashes.append(found)
            endings.append(last_bytes)
            counts[first + 1] += len(found)
            at = end
    return (
        np.concatenate([np.zeros(0, np.uint64), *hashes]),
        np.cumsum(counts),
        np.concatenate([np.zeros(0, np.uint16), *endings]),
    )
