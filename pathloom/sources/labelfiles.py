"""A sink of one label file an image, `<image>.txt` with the image's lines, written by tasks and made visible by a commit."""

from __future__ import annotations

import json
import posixpath
import uuid
from itertools import groupby
from urllib.parse import quote

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..session import ship
from .files import yolo_line

STAGING = "_staging-"


class _Written(WriterCommitMessage):
    """The folder that an attempt wrote, the name it is to have, and how many files and lines it holds."""

    def __init__(self, folder: str, name: str, files: int, lines: int):
        self.folder, self.name, self.files, self.lines = folder, name, files, lines


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class _Writer(DataSourceWriter):
    """Every attempt of a task writes into a staging folder of its own; the commit renames the folders of those that count, one a task, and
    drops the rest, so an attempt that is lost or repeated leaves nothing."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path.rstrip("/"), overwrite, uuid.uuid4().hex

    def write(self, iterator):
        store, root = _store(self.path)
        name = f"part-{TaskContext.get().partitionId():06d}-{self.job[:8]}"
        folder = posixpath.join(root, STAGING + self.job, f"{name}.{uuid.uuid4().hex}")
        files = lines = 0
        for image, rows in groupby(iterator, key=lambda r: r[0]):  # rows come sorted by image
            if not files:
                store.create_dir(folder, recursive=True)
            with store.open_output_stream(posixpath.join(folder, f"{quote(str(image), safe='')}.txt")) as out:
                for row in rows:
                    if row[1] is not None:
                        out.write(row[1].encode() + b"\n")
                        lines += 1
            files += 1
        return _Written(folder, name, files, lines)

    def commit(self, messages):
        from pyarrow import fs

        store, root = _store(self.path)
        if self.overwrite:
            for old in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                name = posixpath.basename(old.path)
                if name.startswith("part-") or name == "_SUCCESS":
                    (store.delete_dir if old.type == fs.FileType.Directory else store.delete_file)(old.path)
        for m in messages:
            if m is not None and m.files:
                store.move(m.folder, posixpath.join(root, m.name))
        self._drop(store, root)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(posixpath.join(root, "_SUCCESS")) as out:
            out.write(json.dumps({"files": sum(m.files for m in messages if m), "lines": sum(m.lines for m in messages if m)}).encode())

    def abort(self, messages):
        self._drop(*_store(self.path))

    def _drop(self, store, root) -> None:
        from pyarrow import fs

        staging = posixpath.join(root, STAGING + self.job)
        if store.get_file_info(staging).type == fs.FileType.Directory:
            store.delete_dir(staging)


class LabelFiles(DataSource):
    """Rows (image, line), those of an image one after another in one partition, as files of one image each."""

    @classmethod
    def name(cls) -> str:
        return "label_files"

    def schema(self) -> str:
        return "image string, line string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if [f.name for f in schema.fields] != ["image", "line"]:
            raise ValueError("rows must be (image, line)")
        return _Writer(self.options["path"], overwrite)


def write_label_files(df: DataFrame, path: str, conf: bool = True, keypoints: str | None = None, mode: str = "append") -> None:
    """One file an image below part-… folders of `path`, a folder that executors share: lines of files.yolo_line(), in order. `df`: (image, cls,
    cx, cy, w, h, conf …). read_labels(spark, f"{path}/part-*") reads them back. An image lies in one task; names are quoted as in URLs."""
    spark = df.sparkSession
    ship(spark)
    spark.dataSource.register(LabelFiles)
    rows = df.select(F.col("image").cast("string").alias("image"), yolo_line(df, conf, keypoints).alias("line"))
    rows.repartition("image").sortWithinPartitions("image", "line").write.format("label_files").mode(mode).save(path)
