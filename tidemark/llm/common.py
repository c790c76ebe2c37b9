"""What the text operators share: a workspace in the shared folder, and words hashed without Python objects.

A word is a run of bytes other than space and the control characters 9 to 13, as in
``[^\\x20\\x09-\\x0D]+``; only the letters A-Z are lower-cased.  Words are found and hashed with numpy on
the Arrow buffers of a batch, in small pieces, so memory follows the piece and not the text.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are taken apart at once.
PIECE = 1 << 18
#: Rows of texts in a batch for Python.
BATCH_ROWS = 1000
_ROWS_SETTING, _ROWS_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACE = _random.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

WORDS = r"[^\x20\x09-\x0D]+"


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers (multiply and shift)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of each ``width`` words in a row."""
    if len(words) < width:
        return words[:0]
    last = len(words) - width + 1
    out = words[:last]
    for k in range(1, width):
        out = chain(out, words[k : last + k])
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column in one array, and the len+1 places where rows begin; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def _places(n: int) -> np.ndarray:
    """Odd multipliers for the places in a word; longer words get more of them, always the same."""
    global _PLACE
    while len(_PLACE) < n:
        more = mix(np.arange(len(_PLACE), 2 * len(_PLACE), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        _PLACE = np.concatenate([_PLACE, more])
    return _PLACE


def _piece_words(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of a piece; ``breaks`` are places where a row begins."""
    solid = ~_SPACE[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    breaks = breaks[(breaks > 0) & (breaks < len(raw))]
    first[breaks] = solid[breaks]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    at = np.flatnonzero(solid)
    lengths = np.diff(np.searchsorted(at, starts), append=len(at))
    begin = np.cumsum(lengths) - lengths
    within = np.arange(len(at)) - np.repeat(begin, lengths)
    value = _BYTE[raw[at]] * _places(int(lengths.max()))[within]
    total = np.add.reduceat(value, begin)
    return starts, starts + lengths, mix(total + lengths.astype(np.uint64))


def batch_words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, word hashes, starts, ends) of each row of a string column; starts and ends are bytes in the row's text.

    Rows are gathered into pieces of ``PIECE`` bytes; a longer text is cut behind white space and put together again.
    """
    raw, at = text_bytes(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(at, at[row] + PIECE, "right")) - 1)
        low, high = int(at[row]), int(at[stop])
        parts = []
        while low < high:
            end = high
            if high - low > PIECE:
                gap = np.flatnonzero(_SPACE[raw[low : low + PIECE]])
                if len(gap):
                    end = low + int(gap[-1]) + 1
                else:  # one word fills the piece: go on to its end
                    end = low + PIECE
                    while end < high and not _SPACE[raw[end]]:
                        end += 1
            starts, ends, hashes = _piece_words(raw[low:end], at[row : stop + 1] - low)
            parts.append((starts + low, ends + low, hashes))
            low = end
        if not parts:
            parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        starts, ends, hashes = (np.concatenate(x) if len(parts) > 1 else x[0] for x in zip(*parts))
        cut = np.searchsorted(starts, at[row : stop + 1])
        for k in range(row, stop):
            a, b = cut[k - row], cut[k - row + 1]
            yield k, hashes[a:b], starts[a:b] - at[k], ends[a:b] - at[k]
        row = stop


class Workspace:
    """Tables of one run in the shared folder that the session names in ``spark.checkpoint.dir``.

    Only a local session may leave the setting out; it then gets a temporary folder.  Rows of texts go to Python in
    batches of ``BATCH_ROWS`` unless the session says otherwise: whole documents are large rows.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        if spark.conf.get(_ROWS_SETTING) == _ROWS_DEFAULT:
            spark.conf.set(_ROWS_SETTING, str(BATCH_ROWS))
        self.path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: lineage ends here, and lost executors don't matter."""
        df.write.mode("overwrite").parquet(self.folder(name))
        return self.spark.read.schema(df.schema).parquet(self.folder(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no returned DataFrame reads any more."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.folder(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="tidemark-llm-")
    return _local_folder


def id_crc32(column: str = "doc_id"):
    """crc32 of an id written as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
