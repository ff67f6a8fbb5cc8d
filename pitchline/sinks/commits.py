"""A log of small JSON entries that several writers may extend.

Entry ``n`` is one file, published by a single put-if-absent: of two writers
that build on the same newest entry, one is refused. Entries are complete
before they become visible, so a reader never sees half of one, and a writer
that dies leaves nothing but files that no entry names. Only these entries
(a few hundred bytes) pass through the driver.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

# Stores whose PUT is atomic and can be refused when the object exists, but
# whose rename is a copy; everywhere else a rename onto a file is refused.
PUT_SCHEMES = ("s3a", "gs", "abfs", "abfss", "wasb", "wasbs")
_ENTRY = re.compile(r"^(\d{12})\.json$")


class Conflict(RuntimeError):
    """Another writer published the entry first."""


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _write(fs, path, text: str, overwrite: bool) -> None:
    out = fs.create(path, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Publish ``text`` as the file ``path``; False if the file is there."""
    from py4j.protocol import Py4JJavaError

    fs, target = _file_system(spark, path)
    fs.mkdirs(target.getParent())
    if fs.exists(target):
        return False
    scheme = fs.getUri().getScheme()
    if scheme in PUT_SCHEMES:
        try:
            _write(fs, target, text, False)
        except Py4JJavaError:
            if fs.exists(target):
                return False
            raise
        return True
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".draft-{uuid.uuid4().hex}")
    _write(fs, draft, text, True)
    try:
        if scheme != "file":
            return fs.rename(draft, target)
        # a local rename would replace the file, a hard link does not
        local = spark._jvm.java.nio.file.Path
        try:
            spark._jvm.java.nio.file.Files.createLink(
                local.of(target.toUri().getPath(), _no_more(spark)), local.of(draft.toUri().getPath(), _no_more(spark)))
            return True
        except Py4JJavaError:
            if fs.exists(target):
                return False
            raise
    finally:
        fs.delete(draft, False)


def _no_more(spark: SparkSession):
    """The empty rest of a Java call with a variable number of names."""
    return spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, target = _file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def versions(spark: SparkSession, log: str) -> list[int]:
    return [int(m[1]) for m in map(_ENTRY.match, names(spark, log)) if m]


def entry(spark: SparkSession, log: str, n: int) -> dict:
    return json.loads(read_text(spark, f"{log}/{n:012d}.json"))


def newest(spark: SparkSession, log: str) -> dict | None:
    found = versions(spark, log)
    return entry(spark, log, found[-1]) if found else None


def publish(spark: SparkSession, log: str, n: int, content: dict) -> None:
    """Publish entry ``n``; :class:`Conflict` if there is one already."""
    if not put_if_absent(spark, f"{log}/{n:012d}.json", json.dumps(content | {"version": n})):
        raise Conflict(f"{log}: entry {n} was published by another writer")
