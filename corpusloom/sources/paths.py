"""Safe paths, storage, and small files on whatever file system a path names."""

from __future__ import annotations

import os
import re
import shutil
import uuid

from pyspark.sql import SparkSession

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._=-]*")


def managed_path(root: str, relative: str) -> str:
    """A path below a root, from plain names only: no absolute or parent parts, and no links on the way."""
    parts = relative.split("/")
    if not all(_NAME.fullmatch(p) for p in parts):
        raise ValueError(f"not a plain relative path: {relative!r}")
    here = os.path.abspath(root)
    for part in ["", *parts]:
        here = os.path.join(here, part) if part else here
        if os.path.islink(here):
            raise ValueError(f"a link on the way: {here}")
    return here


def storage(path: str) -> dict[str, float]:
    """Total, used and free GiB where a path is or will be."""
    while not os.path.exists(path):
        path = os.path.dirname(os.path.abspath(path))
    total, used, free = shutil.disk_usage(path)
    return {"total_gib": total / 2**30, "used_gib": used / 2**30, "free_gib": free / 2**30}


def require_free(path: str, gib: float) -> dict[str, float]:
    """The storage at a path; less free than asked for is an error."""
    if gib < 0:
        raise ValueError("the space asked for can't be negative")
    found = storage(path)
    if found["free_gib"] < gib:
        raise OSError(f"{found['free_gib']:.1f} GiB free at {path}, {gib:g} needed")
    return found


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it; a path without a scheme is on the session's default one."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = file_system(spark, path)
    return fs.exists(place)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; false if there was none."""
    fs, place = file_system(spark, path)
    return fs.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename within a file system; an existing target is an error."""
    fs, place = file_system(spark, source)
    goal = file_system(spark, target)[1]
    if fs.exists(goal):
        raise FileExistsError(target)
    fs.mkdirs(goal.getParent())
    if not fs.rename(place, goal):
        raise OSError(f"{source} couldn't be renamed to {target}")


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file: under another name first, then renamed, in place of an older one."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    fs, place = file_system(spark, part)
    out = fs.create(place, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    goal = file_system(spark, path)[1]
    if fs.exists(goal):
        fs.delete(goal, False)
    if not fs.rename(place, goal):
        raise OSError(f"{path} couldn't be written")


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file's content."""
    fs, place = file_system(spark, path)
    stream = fs.open(place)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def free_bytes(spark: SparkSession, path: str) -> int:
    """What is left on the file system of a path, wherever that is."""
    fs, place = file_system(spark, path)
    while not fs.exists(place):
        place = place.getParent()
    return fs.getStatus(place).getRemaining()
