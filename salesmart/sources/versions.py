"""Versions of stored results: written aside, then made current in one step.

A folder of versions holds data folders and one small file per version that lists
which of them belong to it.  Data is complete before its version file appears, and
a version file never changes, so a reader holds one version from start to end, a
failed build leaves the version before, and of two writers one is refused.
"""

from __future__ import annotations

import json
import os
from uuid import uuid4

from pyspark.sql import SparkSession

from salesmart.sources.shared import delete

VERSIONS = "_versions"


class Conflict(RuntimeError):
    """Another writer made the same version first."""


def _path(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, files.makeQualified(path)


def publish_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` at once; False if it is there already.

    The text is written beside it and then given its name: a rename that refuses an
    existing target, or a link on a local disk, where a rename would replace it.
    """
    files, target = _path(spark, path)
    files.mkdirs(target.getParent())
    if files.getScheme() == "file":
        name = target.toUri().getPath()
        beside = f"{os.path.dirname(name)}/.{uuid4().hex}"
        with open(beside, "x", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(beside, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(beside)
        return True
    beside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid4().hex}")
    out = files.create(beside, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if not files.exists(target) and files.rename(beside, target):
        return True
    files.delete(beside, False)
    return False


def read_file(spark: SparkSession, path: str) -> str:
    files, target = _path(spark, path)
    stream = files.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _path(spark, path)
    return files.exists(target)


def files_below(spark: SparkSession, folder: str) -> list[str]:
    """Files in ``folder`` and all below it, named from there."""
    files, path = _path(spark, folder)
    found, each = [], files.listFiles(path, True)
    while each.hasNext():
        found.append(each.next().getPath().toString()[len(path.toString()) + 1 :])
    return sorted(found)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Move a file unless that is done already."""
    files, old = _path(spark, source)
    _, new = _path(spark, target)
    if files.exists(old):
        files.mkdirs(new.getParent())
        if not files.rename(old, new):
            raise OSError(f"{source} was not moved to {target}")


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in ``folder``, hidden files left out; none if it is missing."""
    files, path = _path(spark, folder)
    if not files.exists(path):
        return []
    return sorted(name for name in (s.getPath().getName() for s in files.listStatus(path)) if not name.startswith("."))


def current(spark: SparkSession, base: str) -> tuple[int, dict]:
    """Number and contents of the newest version; 0 and nothing before the first."""
    numbers = [int(name.removesuffix(".json")) for name in names_in(spark, f"{base}/{VERSIONS}")]
    if not numbers:
        return 0, {}
    return max(numbers), json.loads(read_file(spark, _version(base, max(numbers))))


def commit(spark: SparkSession, base: str, number: int, contents: dict) -> None:
    """Make ``contents`` version ``number``, one more than the one it was made from."""
    if not publish_file(spark, _version(base, number), json.dumps(contents)):
        raise Conflict(f"version {number} of {base} exists")


def _version(base: str, number: int) -> str:
    return f"{base}/{VERSIONS}/{number:010d}.json"


def new_folder(kind: str) -> str:
    """A name for a data folder, not used before."""
    return f"{kind}{uuid4().hex}"


def drop_unlisted(spark: SparkSession, base: str, listed: set[str]) -> None:
    """Delete data folders that no version in use lists: what failed builds and old
    versions left.  Not while another writer may be at work."""
    for name in names_in(spark, base):
        if name != VERSIONS and name not in listed:
            delete(spark, f"{base}/{name}")
