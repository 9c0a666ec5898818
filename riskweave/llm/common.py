"""Small helpers that several text operators share."""

from __future__ import annotations

import gc
import string
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import riskweave
from riskweave.session import delete_folder

#: ASCII white space: space and the code points 9 to 13.
SPACE_CHARS = " \t\n\x0b\x0c\r"

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[ord(c) for c in SPACE_CHARS]] = True

LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32

#: Bytes of text whose words are hashed at once. The work arrays take some 70 bytes a byte of
#: text, and a Python worker keeps what it once took through all stages after.
WORK_BYTES = 1 << 18


def ship(spark: SparkSession) -> None:
    """Sends this library to the Python workers of the session, once."""
    context = spark.sparkContext
    if getattr(context, "_riskweave_shipped", False):
        return
    package = Path(riskweave.__file__).parent
    archive = Path(tempfile.mkdtemp()) / "riskweave.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._riskweave_shipped = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of a test folder, with the library on the workers."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def release(spark: SparkSession) -> None:
    """Lets go of shuffles that are done.

    Shuffle files stay until the driver's collector finds that nobody refers to them, which
    with a large heap may be long after their last use.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_table(table: DataFrame) -> None:
    """Deletes a table that ``materialize`` has made, and lets go of shuffles that are done."""
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        delete_folder(table.sparkSession, folder)
    release(table.sparkSession)


def fresh(table: DataFrame, *names: str) -> list[str]:
    """``names`` behind as many underscores as it takes to clash with no column of ``table``."""
    taken = {c.lower() for c in table.columns}
    front = "_"
    while any(front + n in taken for n in names):
        front += "_"
    return [front + n for n in names]


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other code point as it is."""
    is_ascii = F.octet_length(text) == F.char_length(text)
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(is_ascii, F.lower(text)).otherwise(mapped)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the offset of each; null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(
    texts: pa.Array, most_bytes: int = 4 << 20, most_texts: int | None = None
) -> Iterator[pa.Array]:
    """``texts`` in runs of about ``most_bytes``, so that work arrays stay small.

    ``most_texts`` bounds what grows with the number of texts, however short they are.

    A longer text is a run of its own; it is never cut. No texts give one empty run.
    """
    texts = texts.cast(pa.large_string())
    ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0)))
    start = 0
    if not len(texts):
        yield texts
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        if most_texts:
            stop = min(stop, start + most_texts)
        yield texts.slice(start, stop - start)
        start = stop


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One Arrow list for each count, filled from ``values`` in order."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_POWERS: list[np.ndarray] = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < n:
        for k, factor in enumerate((_ODD, _BACK)):
            _POWERS[k] = np.multiply.accumulate(np.full(n, factor))
    return _POWERS[0][:n], _POWERS[1][:n]


def words(data: np.ndarray, bounds: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, start, end, text index) of every maximal run of bytes that are not ``space``.

    Runs do not cross text bounds. The hash is a polynomial over the bytes, independent of
    the place, and the length, finalised, in 64 bits.
    """
    none = np.empty(0, np.int64)
    if not len(data):
        return none.astype(np.uint64), none, none, none
    solid = ~space
    first = solid.copy()
    first[1:] &= space[:-1]
    last = solid.copy()
    last[:-1] &= space[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = solid[edges]
    last[edges - 1] = solid[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    ahead, back = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * ahead, out=sums[1:])
    value = (sums[end] - sums[start]) * back[start]
    hashed = mix(value + (end - start).astype(np.uint64) * _ODD)
    return hashed, start, end, np.searchsorted(bounds, start, side="right") - 1
