"""Words and n-grams of many texts at once, as numpy arrays over their UTF-8 bytes.

A batch of texts is cut into chunks of about `CHUNK` bytes (one text is never cut), and all work
on a chunk is vectorised. Offsets are bytes within the chunk. A null text is an empty one.
"""

from __future__ import annotations

import ctypes
import pathlib
import tempfile
import zipfile
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.malloc_trim  # noqa: B018
except (OSError, AttributeError):  # another C library
    _libc = None

CHUNK = 1 << 19
U64 = np.uint64
#: An odd multiplier and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: ASCII white space: what `[^\x20\x09-\x0D]+` leaves out.
SPACE = np.zeros(256, np.uint8)
SPACE[[9, 10, 11, 12, 13, 32]] = 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUES = mix((np.arange(1, 257, dtype=np.uint64)) * U64(BASE))
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**i for i < n at least."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have


class Chunk(NamedTuple):
    """Rows `first` to `first + len(offsets) - 1` of a batch and their bytes."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray


def chunks(texts: pa.Array | pa.ChunkedArray, size: int = CHUNK) -> Iterator[Chunk]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield Chunk(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + ((data >= 65) & (data <= 90)) * np.uint8(32)


def spans(kinds: np.ndarray, chunk: Chunk, skip: int = 1) -> Words:
    """Longest runs of bytes of one kind within a text, without those of the kind `skip`."""
    n = len(kinds)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none)
    change = np.empty(n + 1, bool)
    change[0] = change[n] = True
    np.not_equal(kinds[1:], kinds[:-1], out=change[1:n])
    change[chunk.offsets] = True
    edges = np.flatnonzero(change)
    real = kinds[edges[:-1]] != skip
    start, end = edges[:-1][real], edges[1:][real]
    return Words(start, end, np.searchsorted(chunk.offsets, start, "right") - 1)


def words(chunk: Chunk) -> Words:
    return spans(SPACE[chunk.data], chunk)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings data[start:end]; equal strings have equal hashes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * _power(BASE, len(data))[: len(data)], out=sums[1:])
    found = (sums[end] - sums[start]) * _power(INVERSE, len(data) + 1)[start]
    return mix(found + (end - start).astype(np.uint64) * U64(0xD1342543DE82EF95))


def word_hashes(data: np.ndarray, found: Words) -> np.ndarray:
    return span_hashes(data, found.start, found.end)


def ngrams(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n-gram that lies within one row, and the position of its first word."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    many = len(hashes) - n + 1
    value = np.full(many, n, np.uint64)
    for k in range(n):
        value = value * U64(0xD6E8FEB86659FD93) + hashes[k : k + many]
    inside = np.flatnonzero(rows[:many] == rows[n - 1 :])
    return mix(value[inside]), inside


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, the place of one of each, and for each value its number among them."""
    order = np.argsort(values)
    ranked = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(values), np.int64)
    which[order] = np.cumsum(new) - 1
    return ranked[new], order[new], which


def per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights, minlength=n)[:n]


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64, copy=False).view(np.int64)


BATCH_ROWS = 1000


def prepare(df: DataFrame) -> None:
    """Make a session ready for this package's work in Python.

    A batch holds `BATCH_ROWS` rows at most, for rows here are whole texts; a session that asks for
    smaller batches keeps them. Workers get the package itself, wherever they run.
    """
    spark = df.sparkSession
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    context = spark.sparkContext
    if not any("repopulse-llm" in name for name in context.listFiles):
        folder = pathlib.Path(__file__).parent
        # The driver's own file, from which Spark serves it to executors as long as the session lives.
        packed = f"{tempfile.mkdtemp(prefix='repopulse-')}/repopulse-llm.zip"
        with zipfile.ZipFile(packed, "w") as archive:
            archive.write(folder.parent / "__init__.py", "repopulse/__init__.py")
            for path in folder.glob("*.py"):
                archive.write(path, f"repopulse/llm/{path.name}")
        context.addPyFile(packed)


def give_back() -> None:
    """Return freed memory to the system: a worker process lives on after its task, and Arrow and the C
    library would keep what large arrays have left behind."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches one after the other; what one took is given back before the next."""
    for batch in batches:
        yield batch
        del batch
        give_back()


def column(name: str) -> Column:
    """The column of that very name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
