"""Hadoop file-system calls, so paths work on any storage Spark can reach."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, from_path = _resolve(spark, source)
    to_path = spark._jvm.org.apache.hadoop.fs.Path(target)
    if to_path.getParent() is not None:
        fs.mkdirs(to_path.getParent())
    if not fs.rename(from_path, to_path):
        raise OSError(f"Could not move {source} to {target}")


def list_files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Files directly inside a folder whose names end so, whatever the case, by name."""
    fs, target = _resolve(spark, path)
    found = [s.getPath() for s in fs.listStatus(target) if s.isFile() and s.getPath().getName().lower().endswith(suffix)]
    return [p.toString() for p in sorted(found, key=lambda p: p.getName())]


def head(spark: SparkSession, path: str, size: int = 1 << 16) -> bytes:
    """The first bytes of a file."""
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly inside a folder, sorted; none if there is no folder."""
    fs, target = _resolve(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isFile()) if fs.exists(target) else []


def create_whole(spark: SparkSession, path: str, content: bytes) -> bool:
    """Make a file that nobody ever sees half written; False, with nothing changed, if there is one of that name.

    The content is written beside it and then given the name, by a hard link on local disks and by a rename elsewhere. HDFS refuses a
    rename onto a file. A store whose rename overwrites cannot tell two writers apart.
    """
    fs, target = _resolve(spark, path)
    beside = sibling(path, "new")
    fs.mkdirs(target.getParent())
    _, beside_path = _resolve(spark, beside)
    stream = fs.create(beside_path, False)
    stream.write(bytearray(content))
    stream.close()
    try:
        if fs.getScheme() != "file":
            return not fs.exists(target) and fs.rename(beside_path, target)
        os.link(beside_path.toUri().getPath(), target.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        fs.delete(beside_path, False)


def literal(path: str) -> str:
    """The path with the signs escaped that Spark would take as a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def as_given(path: str) -> str:
    """The path that literal was made of."""
    return re.sub(r"\\(.)", r"\1", path)


def base_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def sibling(path: str, tag: str) -> str:
    """A hidden path beside the target, on the same file system. Spark scans skip names that start with '_'."""
    head, _, tail = path.rstrip("/").rpartition("/")
    hidden = f"_{tail}.{tag}-{uuid.uuid4().hex}"
    return f"{head}/{hidden}" if head or path.startswith("/") else hidden


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished staging folder in place of the target; on failure the old target stays."""
    if not exists(spark, target):
        rename(spark, staged, target)
        return
    old = sibling(target, "old")
    rename(spark, target, old)
    try:
        rename(spark, staged, target)
    except Exception:
        rename(spark, old, target)
        raise
    delete(spark, old)


def publish(spark: SparkSession, target: str, write: Callable[[str], None], overwrite: bool = False) -> None:
    """Run write(path) on a staging path, then move it in. A failed write leaves nothing behind."""
    if exists(spark, target) and not overwrite:
        raise FileExistsError(target)
    staged = sibling(target, "staging")
    try:
        write(staged)
        swap_in(spark, staged, target)
    finally:
        if exists(spark, staged):
            delete(spark, staged)
