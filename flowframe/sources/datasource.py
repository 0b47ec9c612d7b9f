"""Displacement field files as a data source: ``spark.read.format("flowfields").load(path)``.

Files are listed once, packed into partitions of about ``partitionBytes`` and read by the tasks; a file that cannot be read
keeps its row and its error. With the option ``pushdown`` (and the session's spark.sql.python.filterPushdown.enabled), filters
on ``path`` are applied to the listing, so other files are never opened. Paths are folders, files or patterns of local or
mounted stores and of those that Arrow opens by URI; a store that only Spark reads goes through ``readers.read_fields``.
"""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage

from . import codecs

KINDS = ("flo", "pfm", "png", "npz", "npy", "bin", "raw")
PARTITION_BYTES = 32 << 20
SCHEMA = "path string, h int, w int, u array<float>, v array<float>, valid array<float>, error string"
_ARROW = pa.schema([("path", pa.string()), ("h", pa.int32()), ("w", pa.int32()), *[(n, pa.list_(pa.float32())) for n in ("u", "v", "valid")], ("error", pa.string())])


def store_of(path: str):
    """(file system, path in it, how to name a path of it as Spark does)."""
    from pyarrow import fs

    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) and not path.startswith("file:"):
        store, at = fs.FileSystem.from_uri(path)
        head = path[: len(path) - len(at)] if path.endswith(at) else ""
        return store, at, lambda p: head + p
    return fs.LocalFileSystem(), os.path.abspath(re.sub("^file:(//)?", "", path)), lambda p: "file:" + p


def listed(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files at a path, in order: a file, all files below a folder, or those that a pattern meets."""
    from pyarrow import fs

    store, at, name = store_of(path)
    hit = re.search(r"[*?\[{]", at)
    base = at[: at.rindex("/", 0, hit.start())] or "/" if hit else at
    info = store.get_file_info(base)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"no such path: {path}")
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(base, recursive=True))
    if hit:
        ways = {"**": ".*", "*": "[^/]*", "?": "[^/]", "{": "(?:", "}": ")", ",": "|"}
        want = re.compile("".join(ways.get(t, t if t[0] == "[" else re.escape(t)) for t in re.findall(r"\*\*|\[[^]]*\]|.", at)) + "(/.*)?")
        found = [f for f in found if want.fullmatch(f.path)]
    found = [f for f in found if f.type == fs.FileType.File and not any(p[:1] in "._" for p in f.path[len(base) :].split("/") if p)]
    return sorted((name(f.path), f.size) for f in found)


@dataclass
class Files(InputPartition):
    paths: list[str]


class FieldReader(DataSourceReader):
    def __init__(self, options):
        if "path" not in options:
            raise ValueError("flowfields needs a path")
        self.path, self.size = options["path"], int(options.get("partitionBytes", PARTITION_BYTES))
        if self.size < 1:
            raise ValueError("partitionBytes must be above 0")
        self.kinds = [k.strip().lower() for k in options.get("kinds", ",".join(KINDS)).split(",")]
        self.tests: list[tuple[str, tuple]] = []

    def partitions(self) -> list[Files]:
        files = [f for f in listed(self.path) if f[0].rpartition(".")[2].lower() in self.kinds and all(meets(f[0], *t) for t in self.tests)]
        out: list[Files] = []
        room = 0
        for path, size in files:
            if not out or size > room:
                out.append(Files([]))
                room = self.size
            out[-1].paths.append(path)
            room -= size
        return out or [Files([])]

    def read(self, partition: Files):
        for path in partition.paths:
            try:
                store, at, _ = store_of(path)
                with store.open_input_stream(at) as f:
                    field, valid = codecs.read_field_valid(path, f.read())
                row = [path, *field.shape[:2], *[np.ravel(field[..., i]).astype(np.float32) for i in (0, 1)], None if valid is None else np.ravel(valid).astype(np.float32), None]
            except Exception as e:  # the row tells
                row = [path, None, None, None, None, None, str(e) or type(e).__name__]
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _ARROW)], schema=_ARROW)


def meets(path: str, kind: str, values: tuple) -> bool:
    return {"in": lambda: path in values, "starts": lambda: path.startswith(values), "ends": lambda: path.endswith(values), "holds": lambda: values[0] in path}[kind]()


class PrunedReader(FieldReader):
    """Reads only files whose path meets the query's filters."""

    def pushFilters(self, filters):
        for f in filters:
            test = None
            if getattr(f, "attribute", None) == ("path",):
                if isinstance(f, EqualTo):
                    test = ("in", (f.value,))
                elif isinstance(f, In):
                    test = ("in", tuple(f.value))
                else:
                    test = next(((k, (f.value,)) for c, k in ((StringStartsWith, "starts"), (StringEndsWith, "ends"), (StringContains, "holds")) if isinstance(f, c)), None)
            if test is None:
                yield f
            else:
                self.tests.append(test)


class FieldWriter(DataSourceWriter):
    """Each row (path, h, w, u, v) as a file below the sink's path, .flo or .png by its name; a file appears whole or not at all."""

    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite

    def write(self, rows):
        n = 0
        store, base, _ = store_of(self.path)
        for row in rows:
            name = row["path"].lstrip("/")
            if ".." in name.split("/"):
                raise ValueError(f"a name must lie below the sink's path: {name}")
            field = np.stack([np.asarray(row["u"], np.float32), np.asarray(row["v"], np.float32)], axis=-1).reshape(row["h"], row["w"], 2)
            kind = name.rpartition(".")[2].lower()
            if kind not in ("flo", "png"):
                raise ValueError(f"fields are written as .flo or .png, not as {name}")
            at = f"{base}/{name}"
            part = f"{at.rpartition('/')[0]}/.{uuid.uuid4().hex}"  # a task that runs twice writes the same bytes
            store.create_dir(at.rpartition("/")[0], recursive=True)
            with store.open_output_stream(part) as f:
                f.write(codecs.write_flo(field) if kind == "flo" else codecs.write_png(codecs.to_kitti(field)))
            store.move(part, at)
            n += 1
        return Written(n)

    def commit(self, messages) -> None:
        pass

    def abort(self, messages) -> None:
        pass


@dataclass
class Written(WriterCommitMessage):
    files: int


class FlowFields(DataSource):
    @classmethod
    def name(cls) -> str:
        return "flowfields"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FieldReader:
        return (PrunedReader if self.options.get("pushdown", "false").lower() == "true" else FieldReader)(self.options)

    def writer(self, schema, overwrite: bool) -> FieldWriter:
        return FieldWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FlowFields)
