"""What the operators share: code on the executors, text as bytes, written tables, names."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.small import settle
from tidelake.session import scratch_dir

__all__ = ["crc_split", "filter_bits", "fresh", "in_filter", "others", "process_value", "scratch_dir", "settle", "ship", "spans", "text_bytes", "word_bytes"]

_PROCESS: dict = {}
_SHIPPED: set[str] = set()

# Bytes that form words: digits, letters (upper case made lower) and everything beyond ASCII; the rest separates.
WORD_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers and bound their Arrow batches.

    Workers do not inherit the driver's ``sys.path``; the package is zipped once per application and sent with
    ``addPyFile``, which Spark serves to executors that join later as well.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        fd, target = tempfile.mkstemp(prefix="tidelake-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(target)
        _SHIPPED.add(context.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def process_value(key, make: Callable):
    """A value that is made once per Python process and key, such as a tokenizer.

    Only the last one is kept: workers live on from stage to stage, and what an earlier one needed would stay in memory.
    What Arrow and the C library still hold of it goes back to the system.
    """
    if key not in _PROCESS:
        _PROCESS.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
        _PROCESS[key] = make()
    return _PROCESS[key]


def text_bytes(column: str = "text") -> Column:
    """The text's UTF-8 bytes, so that no decoding happens between the JVM and Python."""
    return F.col(column).cast("binary")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of one's own, lengthened until ``df`` has no column called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def others(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of ``df`` not called as one of ``names`` in any case, which Spark could not tell apart."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def word_bytes(text: bytes | None) -> list[bytes]:
    """Words of digits, ASCII letters (lower-cased) and bytes beyond ASCII."""
    return text.translate(WORD_TABLE).split() if text else []


def crc_split(column: Column, parts: int, held: int) -> Column:
    """Whether crc32 of the value as text leaves the remainder ``held``; a null value counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % parts == held


def filter_bits(hashes: DataFrame, most: int = 27) -> np.ndarray:
    """A filter of a power of two bits, ``2 ** most`` at most, sized by the number of hashes; set bits are gathered by words of 32."""
    size = 1 << min(most, max(10, (32 * hashes.count()).bit_length()))
    bit = hashes.select(F.col("hash").bitwiseAND(F.lit(size - 1)).alias("b")).distinct()
    words = bit.groupBy(F.shiftright("b", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 32 as int))")).alias("bits"))
    found = words.toArrow()
    out = np.zeros(size >> 5, np.uint32)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be one that ``filter_bits`` was given; all that were given are."""
    low = hashes & np.int64(32 * len(bits) - 1)
    return (bits[low >> 5] >> (low & 31).astype(np.uint32)) & 1 == 1


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places start, start + 1, ... of each span, one span after the other."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)
