"""Small files and folders in any file system that Spark reaches."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, name: str) -> bool:
    path, fs = _path(spark, name)
    return fs.exists(path)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if it does not exist."""
    path, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def read_text(spark: SparkSession, name: str) -> str | None:
    """The content of a small file, or None if it does not exist."""
    path, fs = _path(spark, name)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, name: str, text: str) -> None:
    """Write a small file, replacing one of that name."""
    path, fs = _path(spark, name)
    stream = fs.create(path, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def publish(spark: SparkSession, name: str, text: str) -> bool:
    """Write a small file that appears whole, by rename; False if one of that name is there already.

    Of two writers of one name only one gets True, where the file system renames without replacing.
    """
    path, fs = _path(spark, name)
    if fs.exists(path):
        return False
    fresh = f"{path.getParent()}/.{path.getName()}-{uuid.uuid4().hex}"
    write_text(spark, fresh, text)
    there, _ = _path(spark, fresh)
    try:
        done = fs.rename(there, path)
    except Py4JJavaError:  # some file systems raise where others say no
        done = False
    if not done:
        fs.delete(there, False)
        if not fs.exists(path):
            raise OSError(f"cannot write {name}")
    return done


def remove(spark: SparkSession, name: str) -> None:
    path, fs = _path(spark, name)
    fs.delete(path, True)


class Commits:
    """Numbered states of something in a folder: small JSON files, each put in place by rename. The newest is the state."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in names(self.spark, self.folder) if n.endswith(".json") and n[0] != "."]

    def read(self, number: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.folder}/{number:012d}.json"))

    def newest(self, empty: dict) -> tuple[int, dict]:
        """Number and content of the newest state; 0 and ``empty`` if there is none."""
        found = self.numbers()
        return (found[-1], self.read(found[-1])) if found else (0, empty)

    def put(self, number: int, state: dict) -> bool:
        """Commit a state; False if that number was committed already."""
        return publish(self.spark, f"{self.folder}/{number:012d}.json", json.dumps(state))
