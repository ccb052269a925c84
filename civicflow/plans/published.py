"""Full builds as published versions: a reader sees one complete set of tables, also while the next is built.

Layout under one root (shared storage):

    claims/N      one empty file a build, created exclusively before it starts: its number
    builds/v=N    the tables of build N, as ``marts.materialize`` writes them
    published/N   an empty file, created after the last table of build N is whole

The newest published number is the version in force. A build that dies is never
published and the version before stays in force; two builds at once have
different numbers, and the one that started last is in force once it is done.
Staging stays a view over the raw table that the reader names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import create_file, list_dirs, list_files, remove_dir
from . import marts as M


def _numbers(names: list[str]) -> list[int]:
    return sorted(int(n) for n in names if n.isdigit())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    return _numbers(list_files(spark, f"{root}/published"))


def publish(spark: SparkSession, marts: M.Marts, root: str, by_month: bool = False, keep: int = 2) -> int:
    """Build ``marts`` as a new version and put it in force; returns its number.

    The newest ``keep`` versions are kept (at least one), so readers that opened
    the version before can finish; older ones are removed.
    """
    number = max(_numbers(list_files(spark, f"{root}/claims")), default=-1) + 1
    while not create_file(spark, f"{root}/claims/{number}"):  # another build took it
        number += 1
    M.materialize(spark, marts, f"{root}/builds/v={number}", by_month=by_month)
    create_file(spark, f"{root}/published/{number}")
    retire(spark, root, keep)
    return number


def open_published(spark: SparkSession, root: str, raw: DataFrame, meta: DataFrame | None = None) -> M.Marts:
    """The tables of the version in force, all of one build; raises ``FileNotFoundError`` before the first is published."""
    found = versions(spark, root)
    if not found:
        raise FileNotFoundError(f"no version is published under {root}")
    return M.load(spark, f"{root}/builds/v={found[-1]}", raw, meta)


def retire(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove the builds before the newest ``keep`` published ones, finished or not; returns their numbers.

    A build of a lower number that still runs was overtaken: if it finishes, it is not in force.
    """
    found = versions(spark, root)
    if len(found) <= max(1, keep):
        return []
    first = found[-max(1, keep)]
    for n in found:
        if n < first:  # the mark goes first: a version without its tables is never in force
            remove_dir(spark, f"{root}/published/{n}")
    old = [n for n in _numbers([d.split("=")[-1] for d in list_dirs(spark, f"{root}/builds")]) if n < first]
    for n in old:
        remove_dir(spark, f"{root}/builds/v={n}")
    return old


__all__ = ["publish", "open_published", "versions", "retire"]
