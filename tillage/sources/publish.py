"""Outputs of a run that appear together or not at all."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

POINTER, MANIFEST = "CURRENT", "MANIFEST.json"


class Publication:
    """A new version of a folder's outputs.

    Outputs are written under ``versions/<id>`` of the folder, by any Spark writer, to the places that path() gives. Leaving the ``with``
    block writes a manifest beside them (each output's files and bytes) and then the version's id into CURRENT, which replaces the
    former one by a single rename: readers see all outputs of one version, the old or the new. If the block raises, the
    version is deleted and the folder is as it was. The ``kept`` latest versions stay for readers that are under way.
    """

    def __init__(self, spark: SparkSession, folder: str, kept: int = 2):
        self.spark, self.folder, self.kept = spark, folder.rstrip("/"), kept
        self.version = f"{int(time.time() * 1000):014d}-{uuid.uuid4().hex[:8]}"
        self.base, self.names = f"{self.folder}/versions/{self.version}", []

    def path(self, name: str) -> str:
        """Where an output is to be written."""
        self.names.append(name)
        return f"{self.base}/{name}"

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            _delete(self.spark, self.base)
            return
        absent = [n for n in self.names if not _exists(self.spark, f"{self.base}/{n}")]
        if absent:
            _delete(self.spark, self.base)
            raise FileNotFoundError(f"outputs not written: {', '.join(absent)}")
        manifest = {"version": self.version, "outputs": {n: _files(self.spark, f"{self.base}/{n}") for n in self.names}}
        _write(self.spark, f"{self.base}/{MANIFEST}", json.dumps(manifest, indent=2, sort_keys=True))
        fresh = f"{self.folder}/.{POINTER}-{self.version}"
        _write(self.spark, fresh, self.version)
        _replace(self.spark, fresh, f"{self.folder}/{POINTER}")
        for old in sorted(_names(self.spark, f"{self.folder}/versions"))[: -self.kept]:
            _delete(self.spark, f"{self.folder}/versions/{old}")


def published(spark: SparkSession, folder: str, name: str) -> str:
    """Where an output of the current version is; in a folder without versions, the name itself."""
    pointer = f"{folder.rstrip('/')}/{POINTER}"
    if not _exists(spark, pointer):
        return f"{folder.rstrip('/')}/{name}"
    return f"{folder.rstrip('/')}/versions/{_read(spark, pointer)}/{name}"


def manifest(spark: SparkSession, folder: str) -> dict:
    """The manifest of the current version."""
    return json.loads(_read(spark, published(spark, folder, MANIFEST)))


# ---- the store, through the JVM's file systems ----


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)]


def _files(spark: SparkSession, path: str) -> dict[str, int]:
    """Files of an output and their bytes."""
    fs, p = _fs(spark, path)
    return {s.getPath().getName(): s.getLen() for s in fs.listStatus(p) if s.isFile() and not s.getPath().getName().startswith((".", "_"))}


def _write(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def _read(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    source = fs.open(p)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    source.close()
    return text


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """One rename that takes the place of the target."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, p = _fs(spark, source)
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(p), fs.makeQualified(hadoop.Path(target)), options)
