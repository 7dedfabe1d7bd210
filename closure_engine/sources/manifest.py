"""Folders of Parquet tables that are whole or absent.

A folder is written under another name beside its place, together with a
manifest that lists every table's files and bytes, and takes its place by a
rename when all is written.  Readers check the manifest, so a folder whose
files were lost or mixed afterwards is an error and not a smaller result.
All through Hadoop's file system interface, on any storage that Spark reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

MANIFEST = "_manifest.json"


class _Files:
    """The file system that holds ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"could not rename {old} to {new}")

    def sizes(self, name: str) -> dict[str, int]:
        """Files and bytes of a table's data."""
        found = self.fs.listStatus(self.path(name))
        data = [f for f in found if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
        return {"files": len(data), "bytes": sum(f.getLen() for f in data)}

    def write_text(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def write_folder(spark: SparkSession, path: str, write: Callable[[str], dict], mode: str = "errorifexists") -> dict:
    """``write(folder)`` writes tables into a staging folder and returns facts for the manifest; then the folder becomes ``path``.

    A failure before the end leaves ``path`` as it was and removes the staging
    folder.  ``mode``: errorifexists, ignore or overwrite; an overwritten folder is
    moved aside first and moved back if the new one can't take its place.
    """
    if mode not in ("errorifexists", "error", "ignore", "overwrite"):
        raise ValueError("mode must be errorifexists, ignore or overwrite")
    path = path.rstrip("/")
    files = _Files(spark, path)
    if files.exists(path):
        if mode == "ignore":
            return read_manifest(spark, path)
        if mode != "overwrite":
            raise FileExistsError(path)
    mark = uuid.uuid4().hex
    staging, aside = f"{path}-staging-{mark}", f"{path}-replaced-{mark}"
    try:
        facts = write(staging)
        tables = [f.getPath().getName() for f in files.fs.listStatus(files.path(staging)) if f.isDirectory()]
        manifest = facts | {"tables": {t: files.sizes(f"{staging}/{t}") for t in sorted(tables)}}
        files.write_text(f"{staging}/{MANIFEST}", json.dumps(manifest, sort_keys=True))
    except BaseException:
        files.delete(staging)
        raise
    replaces = files.exists(path)
    if replaces:
        files.rename(path, aside)
    try:
        files.rename(staging, path)
    except BaseException:
        if replaces:
            files.rename(aside, path)
        files.delete(staging)
        raise
    if replaces:
        files.delete(aside)
    return manifest


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The manifest of a folder, after its tables' files and bytes have been compared with it."""
    path = path.rstrip("/")
    files = _Files(spark, path)
    if not files.exists(f"{path}/{MANIFEST}"):
        raise FileNotFoundError(f"{path} holds no whole result")
    manifest = json.loads(files.read_text(f"{path}/{MANIFEST}"))
    for table, sizes in manifest["tables"].items():
        if not files.exists(f"{path}/{table}") or files.sizes(f"{path}/{table}") != sizes:
            raise ValueError(f"{path}/{table} is not the table that was written")
    return manifest
