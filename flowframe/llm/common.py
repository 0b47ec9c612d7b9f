"""What the text operators share: table access, a shared work folder, and vectorised work on blocks of UTF-8 bytes.

A *block* is a run of whole documents of about ``BLOCK_BYTES`` bytes. Every Arrow batch is cut into blocks first, so
the memory of a Python worker is set by the block (or by the longest document), never by the batch or the partition.
"""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
#: Rows of an Arrow batch where the session leaves Spark's default: whole texts are long, so a batch holds few of them.
BATCH_ROWS = 512
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_ROWS`` rows from here on, unless the session has a limit of its own."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one the session names, or a temporary one in local mode (tests)."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="flowframe-"))
    return sc._jsc.sc().getCheckpointDir().get()


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        remove(df.sparkSession, df.staged_at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store through Spark's own file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text) alone, null text as empty: clashing or extra columns never reach an operator."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def blocks(batch: pa.RecordBatch, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of each block of a batch with a string column ``text``."""
    col = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
    n = len(col)
    if not n:
        return
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.empty(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + max_bytes, "right")) - 1)
        end = min(end, n)
        yield at, end - at, data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def gathered(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Consecutive batches as one, up to about ``max_bytes``, so that blocks are not cut short by small batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(b.nbytes for b in held) + batch.nbytes > max_bytes:
            yield held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        if batch.num_rows:
            held.append(batch)
    if held:
        yield held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def tidy(run: Callable) -> Callable:
    """A function of batches for ``mapInArrow`` that gives free memory back when its task ends: workers outlive tasks."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def give_back() -> None:
    """Return memory that Arrow and the C library hold but do not use to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def map_blocks(df: DataFrame, fn: Callable, schema: str, max_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``blockwise`` in small Arrow batches."""
    small_batches(df.sparkSession)
    return blockwise(df, fn, schema, max_bytes)


def blockwise(df: DataFrame, fn: Callable, schema: str, max_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``fn(ids, data, offs) -> list of Arrow arrays or None`` over every block of (doc_id, text)."""
    out = pa.schema(_arrow(df.sparkSession, schema))

    def run(batches):
        for batch in gathered(batches, max_bytes):
            ids = batch.column(0)
            for at, n, data, offs in blocks(batch, max_bytes):
                cols = fn(ids.slice(at, n), data, offs)
                if cols is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type) for c, f in zip(cols, out)], schema=out)

    return df.select("doc_id", "text").mapInArrow(tidy(run), schema)


def _arrow(spark: SparkSession, ddl: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return list(to_arrow_schema(StructType.fromDDL(ddl)))


#: Multiplier of the polynomial hash; odd, so that every power has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 17
_ONES = np.append(np.array([(1 << 8 * i) - 1 for i in range(8)], np.uint64), np.uint64(2**64 - 1))
_GOLD, _SIZE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def powers(n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006  one table per worker
    """BASE**i and its inverse modulo 2**64, for i below at least n."""
    if len(cache.get("p", ())) < n:
        for name, base in (("p", BASE), ("q", pow(BASE, -1, 1 << 64))):
            p = np.full(max(n, (1 << 19) + 1), base, np.uint64)
            p[0] = 1
            cache[name] = np.cumprod(p)
    return cache["p"], cache["q"]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def _pieces(starts: np.ndarray, size: np.ndarray):
    """Each span in pieces of eight bytes: place, mask, number within the span; and the first piece of each span."""
    count = np.maximum((size + 7) >> 3, 1)
    first = np.cumsum(count) - count
    i = np.arange(int(count.sum())) - np.repeat(first, count)
    at = np.repeat(starts, count) + 8 * i
    return at, _ONES[np.minimum(np.repeat(size, count) - 8 * i, 8)], i, first


def _stretches(starts: np.ndarray, ends: np.ndarray):
    """Runs of spans that hold about ``_CHUNK`` bytes."""
    total = np.cumsum(ends - starts + 8)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + 8 * _CHUNK, "right")))
        yield at, to
        at = to


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span by its content alone; other seeds give independent hashes.

    Pieces of eight bytes are scrambled twice, with the piece's number between, before they are added, so no pattern of
    the bytes cancels. Spans of up to eight bytes and equal length never collide.
    """
    out = np.empty(len(starts), np.uint64)
    see = eights(data)
    for a, b in _stretches(starts, ends):
        size = ends[a:b] - starts[a:b]
        at, mask, i, first = _pieces(starts[a:b], size)
        x = mix((see[at] & mask) + np.uint64(mixed(seed)))
        x = mix(x + (i.astype(np.uint64) + np.uint64(1)) * _GOLD)
        out[a:b] = mix(np.add.reduceat(x, first) + size.astype(np.uint64) * _SIZE)
    return out


def mixed(seed: int) -> int:
    return int(mix(np.array([seed], np.uint64))[0])


def span_equal(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, starts2: np.ndarray, ends2: np.ndarray) -> np.ndarray:
    """Whether each span of ``data`` holds the same bytes as its span of ``other``."""
    out = ends - starts == ends2 - starts2
    see, see2 = eights(data), eights(other)
    rows = np.flatnonzero(out)
    for a, b in _stretches(starts[rows], ends[rows]):
        r = rows[a:b]
        at, mask, _, first = _pieces(starts[r], ends[r] - starts[r])
        move = np.repeat(starts2[r] - starts[r], np.diff(np.append(first, len(at))))
        out[r] = ~np.logical_or.reduceat((see[at] ^ see2[at + move]) & mask != 0, first)
    return out


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` that do not cross documents: starts, ends, and the word offsets of each document."""
    n = len(inside)
    if not n:
        z = np.empty(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    prev = np.empty(n, bool)
    prev[0] = False
    prev[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~prev | cut[:-1]))
    nxt = np.empty(n, bool)
    nxt[-1] = False
    nxt[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~nxt | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def space_words(data: np.ndarray, offs: np.ndarray):
    """Words ``[^\\x20\\x09-\\x0D]+`` of each document."""
    return runs(~_SPACE[data], offs)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges start..start+length."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)


def joined_on_id(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on doc_id, nulls equal; by sort and merge at every size, as ids grow with the documents."""
    name = free_name(docs, "id")
    other = ids.select(F.col("doc_id").alias(name)).hint("merge")
    return docs.join(other, docs["doc_id"].eqNullSafe(F.col(name)), how)


def free_name(docs: DataFrame, name: str) -> str:
    """``name`` behind as many underscores as no column of ``docs`` has, whatever its letter case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken or not name.startswith("__"):
        name = "_" + name
    return name
