"""Document lengths of flat token files that hold no index, by a separator scan.

A token file is one array of unsigned ids; an end-of-document id follows each document. Files are read in blocks of fixed
size that know nothing of documents. Each block is searched by one vector comparison; what spans blocks is stitched by a
prefix scan over one small row a block: token positions by prefix sum, the last separator before a block by prefix
maximum, document ordinals by prefix count.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .bpe import BYTES, encoder, vocabulary_path
from .common import blocks as text_blocks
from .common import discard, gathered, remove, shared_dir, small_batches, staged, texts, tidy

END = 50256
BLOCK_TOKENS = 1 << 16
#: Blocks of a file whose prefix sums one task makes.
CHUNK = 1 << 12
_BLOCKS = "file string, block long, tokens binary"


def scan(blocks: DataFrame, end: int = END, width: int = 4) -> DataFrame:
    """(file, ordinal, start, n_tokens) of every document in blocks (file, block, tokens binary).

    Tokens after a file's last separator are a document of their own; two separators in a row hold an empty document. A
    null or empty block holds nothing. ``block`` orders the blocks of a file; repeated blocks are a defect of the input.
    """
    out = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("last", pa.int64()), ("ends", pa.list_(pa.int64()))])
    kind = np.dtype(f"<u{width}")

    def search(batches):
        for batch in batches:
            rows: dict = {k: [] for k in out.names}
            for file, block, raw in zip(*(batch.column(i) for i in range(3))):
                ids = np.frombuffer(raw.as_py() or b"", kind)
                hits = np.flatnonzero(ids == end)
                for k, x in zip(out.names, (file.as_py(), block.as_py(), len(ids), int(hits[-1]) if len(hits) else None, hits.tolist())):
                    rows[k].append(x)
            yield pa.RecordBatch.from_pydict(rows, schema=out)

    found = blocks.select("file", "block", "tokens").mapInArrow(tidy(search), "file string, block long, n long, last long, ends array<long>")
    found = staged(found.withColumn("m", F.size("ends").cast("long")), "token-ends")
    # the prefix scan sees one small row a block: first within chunks of a file, then over the chunks
    part = found.select("file", "block", F.floor(F.col("block") / CHUNK).alias("chunk"), "n", "m", "last")
    own = W.partitionBy("file", "chunk").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    part = part.withColumns({"base": F.coalesce(F.sum("n").over(own), F.lit(0)), "docs": F.coalesce(F.sum("m").over(own), F.lit(0))})
    part = part.withColumn("open", F.max(F.col("base") + F.col("last")).over(own))
    chunks = part.groupBy("file", "chunk").agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.max(F.col("base") + F.col("last")).alias("last"))
    all_ = W.partitionBy("file").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)  # a row for each CHUNK blocks
    chunks = chunks.withColumns({"first": F.coalesce(F.sum("n").over(all_), F.lit(0)), "before": F.coalesce(F.sum("m").over(all_), F.lit(0))})
    chunks = chunks.select("file", "chunk", "first", "before", F.max(F.col("first") + F.col("last")).over(all_).alias("held"), "n", "m", "last")
    at = part.select("file", "block", "chunk", "base", "docs", "open").join(chunks.select("file", "chunk", "first", "before", "held"), ["file", "chunk"])
    at = at.select("file", "block", (F.col("first") + F.col("base")).alias("base"), (F.col("before") + F.col("docs")).alias("docs"), F.coalesce(F.col("first") + F.col("open"), "held", F.lit(-1)).alias("open"))
    base = found.where("m > 0").select("file", "block", "ends").join(at, ["file", "block"])
    ends = base.select("file", "base", "docs", "open", "ends", F.posexplode("ends").alias("i", "at"))
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("base") + F.get("ends", F.col("i") - 1)) + 1
    whole = ends.select("file", (F.col("docs") + F.col("i")).alias("ordinal"), start.alias("start"), (F.col("base") + F.col("at") - start).alias("n_tokens"))
    tail = chunks.groupBy("file").agg(F.sum("n").alias("n"), F.sum("m").alias("ordinal"), F.max(F.col("first") + F.col("last")).alias("stop"))
    tail = tail.withColumn("start", F.coalesce("stop", F.lit(-1)) + 1).where("n > start")
    out = whole.unionByName(tail.select("file", "ordinal", "start", (F.col("n") - F.col("start")).alias("n_tokens")))
    out.staged_at = found.staged_at
    return out


def store_of(uri: str):
    """The file system of a path as Spark names it, and the path there; what stands in a name is never read as an escape."""
    from pyarrow import fs

    scheme = uri.partition(":")[0] if ":" in uri.partition("/")[0] else "file"
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    host, _, path = uri.partition("://")[2].partition("/")
    store, base = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return store, f"{base.rstrip('/')}/{path}"


def read_token_files(spark: SparkSession, path: str, width: int = 4, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks (file, block, tokens) of the flat token files at ``path``, of any size: each task reads the ranges of its blocks.

    Files are listed by Spark's reader, which tells their lengths without their content. A file that shrinks meanwhile is an
    error. An empty file has no block.
    """
    size = block_tokens * width
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length").where("length > 0")
    ranges = files.select("file", "length", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("length") - 1).cast("long"), F.lit(size).cast("long"))).alias("at"))

    def read(batches):
        held = ("", None)
        for batch in batches:
            for file, length, at in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held[0] != file:
                    store, name = store_of(file)
                    held = (file, store.open_input_file(name))
                held[1].seek(at)
                raw = held[1].read(min(size, length - at))
                if len(raw) < min(size, length - at):
                    raise ValueError(f"{file} is shorter than it was listed")
                yield pa.RecordBatch.from_pydict({"file": [file], "block": [at // size], "tokens": [raw]})

    return ranges.repartitionByRange("file", "at").mapInArrow(read, _BLOCKS)


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, width: int = 2) -> DataFrame:
    """Documents as flat token files below ``folder``, one a task, each document closed by ``END``; and (file, first, ids): which
    documents stand in a file from ordinal ``first`` on.

    A task writes under a name of its own and moves the whole file into place, so a task that runs again changes nothing. Ids
    of up to 16 bits take two bytes.
    """
    path = path or vocabulary_path()
    out = pa.schema([("file", pa.string()), ("first", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(batches):
        from pyspark import TaskContext

        file, enc, ordinal, sink = f"{TaskContext.get().partitionId():08d}.tokens", encoder(path), 0, None
        store, base = store_of(folder)
        part = f"{base}/.{uuid.uuid4().hex}"
        try:
            for batch in gathered(batches, BYTES):
                for at, n, data, offs in text_blocks(batch, BYTES):
                    if sink is None:
                        store.create_dir(base, recursive=True)
                        sink = store.open_output_stream(part)
                    ids, cuts = enc.plain(data, offs)
                    flat = np.full(len(ids) + n, END, f"<u{width}")
                    flat[np.delete(np.arange(len(flat)), cuts[1:] + np.arange(n))] = ids
                    sink.write(flat.tobytes())
                    yield pa.RecordBatch.from_pydict({"file": [file], "first": [ordinal], "ids": [batch.column(0).slice(at, n).to_pylist()]}, schema=out)
                    ordinal += n
        finally:
            if sink is not None:
                sink.close()
        if sink is not None:
            store.move(part, f"{base}/{file}")

    small_batches(docs.sparkSession)
    return texts(docs).mapInArrow(tidy(run), "file string, first long, ids array<long>")


def counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, file, ordinal, start) of every row, read off flat token files alone.

    The files are written below the shared folder and scanned as any others are; they are deleted behind the result. Null text
    counts as empty and has no token; rows that repeat an id, or have none, are documents of their own. A text that spells a
    special token is encoded as ordinary text, so that the separator ids in the files are the ends of documents and nothing else.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    names = staged(write_token_files(docs, folder, path), "token-names")
    if not names.limit(1).count():
        return names.select(F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_tokens"), "file", F.col("first").alias("ordinal"), F.col("first").alias("start"))
    found = scan(read_token_files(spark, folder, width=2), width=2)
    each = names.select("file", "first", F.posexplode("ids").alias("i", "doc_id")).select("file", (F.col("first") + F.col("i")).alias("ordinal"), "doc_id")
    named = found.withColumn("file", F.substring_index("file", "/", -1))
    out = staged(each.join(named, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start"), "token-counts")
    discard(names, found)
    remove(spark, folder)
    return out
