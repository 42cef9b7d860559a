"""Finding register directories on any Hadoop file system."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def list_names(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name → full path of everything in a folder, sorted by name.

    Names starting with ``_`` or ``.`` are markers, as in Spark's own reader.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {str(s.getPath().getName()): str(s.getPath().toString()) for s in system.listStatus(path)}
    return {n: found[n] for n in sorted(found) if n[0] not in "_."}


def list_periods(spark: SparkSession, folder: str, pattern: str) -> dict[str, str]:
    """The entries whose name matches a regular expression from its start."""
    wanted = re.compile(pattern)
    return {n: p for n, p in list_names(spark, folder).items() if wanted.match(n)}


def locate(spark: SparkSession, root: str, *parts: str) -> str:
    """A path below ``root`` where the case of each part does not matter."""
    at = root
    for part in parts:
        names = list_names(spark, at)
        if part in names:
            at = names[part]
            continue
        same = [p for n, p in names.items() if n.lower() == part.lower()]
        if len(same) != 1:
            raise FileNotFoundError(f"{len(same)} entries named {part!r} in {at}")
        at = same[0]
    return at
