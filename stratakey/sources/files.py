"""Small files on shared storage, from the driver's JVM or, where a process has none, by Arrow's file systems."""

from __future__ import annotations

import os
import re
import uuid
from typing import Any, Protocol

from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder under spark.checkpoint.dir, or, for a session in one process only, in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


class Files(Protocol):
    def names(self, folder: str) -> list[str]: ...
    def exists(self, path: str) -> bool: ...
    def read(self, path: str) -> str: ...
    def publish(self, path: str, text: str) -> None: ...
    def delete(self, path: str) -> None: ...


def publish_local(path: str, draft: str, text: str) -> None:
    os.makedirs(os.path.dirname(draft), exist_ok=True)
    with open(draft, "wb") as f:
        f.write(text.encode())
    try:
        os.link(draft, path)
    finally:
        os.remove(draft)


class JvmFiles:
    """Any file system that Spark itself can use."""

    def __init__(self, spark: SparkSession):
        self.spark, self.conf = spark, spark._jsc.hadoopConfiguration()
        # naming a class asks the JVM about each part of the name, so it is done once
        jvm = spark._jvm
        self._path, self._context, self._io = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs.FileContext, jvm.org.apache.commons.io.IOUtils
        self._options = spark._sc._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)

    def place(self, path: str) -> tuple[Any, Any]:
        p = self._path(path)
        return p, p.getFileSystem(self.conf)

    def names(self, folder: str) -> list[str]:
        p, fs = self.place(folder)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def exists(self, path: str) -> bool:
        p, fs = self.place(path)
        return fs.exists(p)

    def read(self, path: str) -> str:
        p, fs = self.place(path)
        stream = fs.open(p)
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Makes a file appear whole; FileExistsError if there is one of that name."""
        folder, name = path.rsplit("/", 1)
        draft, fs = self.place(f"{folder}/drafts/{uuid.uuid4().hex}")
        if fs.getUri().getScheme() == "file":
            # Hadoop's local rename starts a process for each file that it looks at
            return publish_local(self._path(path).toUri().getPath(), draft.toUri().getPath(), text)
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        final = self._path(f"{folder}/{name}")
        context = self._context.getFileContext(final.toUri(), self.conf)
        try:
            context.rename(context.makeQualified(draft), context.makeQualified(final), self._options)
        except Exception as e:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                raise FileExistsError(path) from e
            raise

    def delete(self, path: str) -> None:
        p, fs = self.place(path)
        fs.delete(p, True)


class ArrowFiles:
    """The same without a JVM, for the processes in which Spark runs Python data sources."""

    @staticmethod
    def place(path: str) -> tuple[arrow_fs.FileSystem, str]:
        return arrow_fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")

    def listed(self, folder: str, recursive: bool = False) -> list[arrow_fs.FileInfo]:
        fs, p = self.place(folder)
        return fs.get_file_info(arrow_fs.FileSelector(p, allow_not_found=True, recursive=recursive))

    def names(self, folder: str) -> list[str]:
        return [i.base_name for i in self.listed(folder)]

    def exists(self, path: str) -> bool:
        fs, p = self.place(path)
        return fs.get_file_info(p).type != arrow_fs.FileType.NotFound

    def read(self, path: str) -> str:
        fs, p = self.place(path)
        with fs.open_input_stream(p) as f:
            return f.read().decode()

    def publish(self, path: str, text: str) -> None:
        fs, p = self.place(path)
        folder, name = p.rsplit("/", 1)
        draft = f"{folder}/drafts/{uuid.uuid4().hex}"
        fs.create_dir(f"{folder}/drafts", recursive=True)
        with fs.open_output_stream(draft) as f:
            f.write(text.encode())
        try:
            if isinstance(fs, arrow_fs.LocalFileSystem):
                os.link(draft, p)
                os.remove(draft)
            elif fs.type_name == "hdfs":  # a rename there fails if the name is taken
                fs.move(draft, p)
            else:
                raise NotImplementedError(f"{fs.type_name} has no rename that spares an existing file; write through KeyedTable")
        except OSError as e:
            fs.delete_file(draft)
            if fs.get_file_info(p).type != arrow_fs.FileType.NotFound:
                raise FileExistsError(path) from e
            raise

    def delete(self, path: str) -> None:
        fs, p = self.place(path)
        kind = fs.get_file_info(p).type
        if kind == arrow_fs.FileType.Directory:
            fs.delete_dir(p)
        elif kind != arrow_fs.FileType.NotFound:
            fs.delete_file(p)
