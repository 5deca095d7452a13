"""Replacing one day of a table without a moment in which the day is missing.

A day's folder holds a folder per version and an empty file ``_commit-<n>`` for each finished
one. Readers take the version with the highest commit, so they see the old day until the commit
of the new one exists, and whole days at any time. The version before the last one stays for
readers that have already begun; older ones go with the next replacement. Plain files in the
day's folder, as bulk writers leave them, count as its version 0.

A writer claims the next number before it writes. If someone else has committed since, its
result rests on a state that is gone, and it is refused. Two claims of one number exclude each
other where the file system creates a file at most once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gridmargin.sources.storage import _file_system, has_files

_PARQUET_FILES = "*.parquet"
_MARK = re.compile(r"(_claim|_commit|version)-(\d+)$")
_CLAIMS = 100


class StaleVersionError(RuntimeError):
    """Another writer has replaced the day since this one began."""


def _marks(fs, folder) -> dict[str, set[int]]:
    """Numbers of the claims, commits and version folders of a day."""
    found: dict[str, set[int]] = {"_claim": set(), "_commit": set(), "version": set()}
    if fs.exists(folder):
        for status in fs.listStatus(folder):
            if m := _MARK.match(status.getPath().getName()):
                found[m[1]].add(int(m[2]))
    return found


def _created(fs, path) -> bool:
    """Make an empty file; False if it is there already."""
    try:
        fs.create(path, False).close()
    except Py4JJavaError:
        if fs.exists(path):
            return False
        raise
    return True


def current_version(spark: SparkSession, folder: str) -> int:
    """The number of the version that readers of a day see, 0 for plain files or nothing."""
    return max(_marks(*_file_system(spark, folder))["_commit"], default=0)


def replace_version(
    spark: SparkSession,
    folder: str,
    write: Callable[[str], None],
    check: Callable[[], None] | None = None,
    based_on: int | None = None,
) -> int:
    """Write and check a new version of a day, then commit it; returns its number.

    A failing write or check leaves the day as it was. ``based_on`` is the version that the new
    one was made from, by default the one current when this call begins; if another one is
    current at the end, StaleVersionError is raised and nothing changes.
    """
    fs, day = _file_system(spark, folder)
    child = lambda name: spark._jvm.org.apache.hadoop.fs.Path(day, name)
    marks = _marks(fs, day)
    before = max(marks["_commit"], default=0) if based_on is None else based_on
    first = 1 + max([before, *marks["_claim"], *marks["_commit"], *marks["version"]])
    number = next((n for n in range(first, first + _CLAIMS) if _created(fs, child(f"_claim-{n}"))), None)
    if number is None:
        raise StaleVersionError(f"{folder}: other writers claim every next version")
    version, done = child(f"version-{number}"), False
    try:
        write(version.toString())
        if check is not None:
            check()
        now = max(_marks(fs, day)["_commit"], default=0)
        if now != before:
            raise StaleVersionError(f"{folder}: version {now} came in place of {before} meanwhile")
        done = _created(fs, child(f"_commit-{number}"))
    finally:
        if not done:
            fs.delete(version, True)
        fs.delete(child(f"_claim-{number}"), False)
        if not fs.listStatus(day):
            fs.delete(day, False)
    _clean(fs, day, child, before)
    return number


def _clean(fs, day, child, kept: int) -> None:
    """Delete what is older than version ``kept``, the one that readers may still be reading."""
    if kept:
        for status in fs.listStatus(day):
            name = status.getPath().getName()
            if not _MARK.match(name):
                fs.delete(status.getPath(), True)
    for kind, numbers in _marks(fs, day).items():
        for n in numbers:
            if n < kept and kind != "_claim":
                fs.delete(child(f"{kind}-{n}"), True)


def current_paths(spark: SparkSession, table: str, column: str = "dt") -> dict[str, str]:
    """Folder of the current version of every day of a table, by the day's text."""
    fs, root = _file_system(spark, table)
    path = spark._jvm.org.apache.hadoop.fs.Path
    found = {}
    for status in fs.globStatus(path(root, f"{column}=*")) or []:
        found[status.getPath().getName().split("=", 1)[1]] = (0, status.getPath().toString())
    for status in fs.globStatus(path(root, f"{column}=*/_commit-*")) or []:
        day = status.getPath().getParent()
        number = int(_MARK.match(status.getPath().getName())[2])
        name = day.getName().split("=", 1)[1]
        found[name] = max(found[name], (number, f"{day.toString()}/version-{number}"))
    return {name: folder for name, (number, folder) in found.items() if number or has_files(spark, folder, _PARQUET_FILES)}


def read_versions(
    spark: SparkSession,
    table: str,
    schema: StructType,
    column: str = "dt",
    days: Iterable[date | str] | None = None,
) -> DataFrame:
    """The current version of every day of a table, or of some days only.

    A filter on the day prunes folders. A table without days is empty. The versions are
    resolved when this is called: a frame goes on reading those it began with.
    """
    root = table.rstrip("/")
    if not has_files(spark, root, f"{column}=*"):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("pathGlobFilter", _PARQUET_FILES)
    if days is None and not has_files(spark, root, f"{column}=*/_commit-*"):
        return reader.parquet(root)  # plain files only
    paths = current_paths(spark, root, column)
    chosen = sorted(paths if days is None else {str(d) for d in days} & set(paths))
    if not chosen:
        return spark.createDataFrame([], schema)
    return reader.option("basePath", root).parquet(*[paths[d] for d in chosen])
