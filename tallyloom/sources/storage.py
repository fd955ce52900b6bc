"""Where jobs put intermediate tables, and the few file operations they need."""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder for intermediate tables, below the cluster's checkpoint folder.

    Only a local session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tallyloom-")
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    fs, p = _path(spark, folder)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def age_hours(spark: SparkSession, path: str) -> float:
    fs, p = _path(spark, path)
    return (time.time() - fs.getFileStatus(p).getModificationTime() / 1000) / 3600


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, over one of that name."""
    fs, p = _path(spark, path)
    stream = fs.create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place whole, by one step; False if there is one of that name."""
    jvm = spark._jvm
    fs, target = _path(spark, path)
    target = fs.makeQualified(target)
    fs.mkdirs(target.getParent())
    waiting = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(waiting, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        return _move_new(spark, fs, waiting, target)
    finally:
        fs.delete(waiting, False)


def _move_new(spark: SparkSession, fs, source, target) -> bool:
    """Give a file its name unless the name is taken."""
    if fs.getScheme() == "file":  # there a rename replaces what it finds; a link doesn't
        try:
            os.link(source.toUri().getPath(), target.toUri().getPath())
            return True
        except FileExistsError:
            return False
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(target), options)
        return True
    except Exception:
        if fs.exists(source) and fs.exists(target):
            return False
        raise


def move_folder(spark: SparkSession, source: str, target: str) -> bool:
    """Give a folder a name that isn't taken; False if it is."""
    fs, here = _path(spark, source)
    _, there = _path(spark, target)
    fs.mkdirs(there.getParent())
    return not fs.exists(there) and fs.rename(here, there)


def move(spark: SparkSession, source: str, folder: str) -> str:
    """Move a file into a folder; a name that is taken gets the first free suffix."""
    fs, here = _path(spark, source)
    _, into = _path(spark, folder)
    fs.mkdirs(into)
    stem, dot, kind = here.getName().rpartition(".")
    stem, kind = (stem, dot + kind) if stem else (kind, "")
    n = 0
    while True:
        target = spark._jvm.org.apache.hadoop.fs.Path(into, f"{stem}_{n}{kind}" if n else stem + kind)
        if not fs.exists(target) and fs.rename(here, target):
            return target.toString()
        if not fs.exists(here):
            raise FileNotFoundError(source)
        n += 1
