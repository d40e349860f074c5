"""Directories in whatever storage Spark reads, through its Hadoop file systems."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    storage, place = _at(spark, path)
    return storage.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory if it is there."""
    storage, place = _at(spark, path)
    storage.delete(place, True)


def bytes_of(spark: SparkSession, path: str) -> int:
    """The size of a file, or of all files below a directory."""
    storage, place = _at(spark, path)
    return storage.getContentSummary(place).getLength()


def children(spark: SparkSession, path: str) -> list[str]:
    """Directories right below a path, oldest first."""
    storage, place = _at(spark, path)
    if not storage.exists(place):
        return []
    found = [x for x in storage.listStatus(place) if x.isDirectory()]
    found.sort(key=lambda x: x.getModificationTime())
    return [x.getPath().toString() for x in found]


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Names of all data files below a path, relative to it; hidden ones are left out."""
    storage, place = _at(spark, path)
    if not storage.exists(place):
        return []
    root = storage.getFileStatus(place).getPath().toUri().getPath().rstrip("/") + "/"
    found, files = [], storage.listFiles(place, True)
    while files.hasNext():
        name = files.next().getPath().toUri().getPath().removeprefix(root)
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            found.append(name)
    return sorted(found)


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet."""
    storage, place = _at(spark, path)
    out = storage.create(place, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The contents of a small file."""
    storage, place = _at(spark, path)
    stream = storage.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_directory(spark: SparkSession, new: str, path: str) -> None:
    """Put a completely written directory in the place of another.

    Two renames: the old data is moved aside and only deleted when the new one stands
    in its place. If the second rename fails the old data is moved back.
    """
    storage, place = _at(spark, path)
    fresh = spark._jvm.org.apache.hadoop.fs.Path(new)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}-replaced-{uuid4().hex}")
    storage.mkdirs(place.getParent())
    had = storage.exists(place)
    if had and not storage.rename(place, aside):
        raise OSError(f"{path} cannot be moved aside")
    if not storage.rename(fresh, place):
        if had:
            storage.rename(aside, place)
        raise OSError(f"{new} cannot be moved to {path}")
    if had:
        storage.delete(aside, True)
