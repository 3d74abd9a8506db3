"""Numbered versions of a table's state: small JSON files of which the newest counts.

Data are written first, to folders that no version names yet; then one file is put in its
place by a rename, so a reader sees the state before or after a step and never one between.
A step that dies leaves folders that nothing names. A table has one writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_versions"


def _files(spark: SparkSession, path: str):
    """The folder ``path`` and its file system."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it isn't there."""
    folder, system = _files(spark, path)
    if not system.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    folder, system = _files(spark, f"{root.rstrip('/')}/{FOLDER}")
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[0].isdigit())


def _version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{version:09d}.json"


def state_of(spark: SparkSession, root: str, version: int) -> dict:
    path, system = _files(spark, _version_path(root, version))
    stream = system.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def newest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """The newest version's number and state; 0 and an empty state before the first one."""
    found = versions(spark, root)
    return (found[-1], state_of(spark, root, found[-1])) if found else (0, {})


def publish(spark: SparkSession, root: str, version: int, state: dict) -> None:
    """Make ``state`` the version of that number. Another writer's version of it is an error."""
    target, system = _files(spark, _version_path(root, version))
    if system.exists(target):
        raise FileExistsError(f"version {version} of {root} is there already")
    written, _ = _files(spark, f"{root.rstrip('/')}/{FOLDER}/.{uuid.uuid4().hex}")
    stream = system.create(written)
    try:
        stream.write(bytearray(json.dumps(state).encode()))
    finally:
        stream.close()
    if not system.rename(written, target):
        raise OSError(f"version {version} of {root} could not be published")


def forget(spark: SparkSession, root: str, before: int) -> None:
    """Delete the states of versions below ``before``, never the newest; what they name stays."""
    for version in versions(spark, root)[:-1]:
        if version < before:
            path, system = _files(spark, _version_path(root, version))
            system.delete(path, False)
