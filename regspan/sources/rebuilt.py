"""Results that are kept and made again only when something they depend on has changed."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

# Leaves of a plan that compute their rows from nothing but numbers.
_COMPUTED = ("Range", "OneRowRelation")
# Columns per node that a plan's text shows, in effect all.
_ALL = 1_000_000


def _sources(plan) -> Iterator[tuple[str, list[str] | None, str]]:
    """Kind, files and columns of each leaf of a plan, in order; files are None where a leaf has none."""
    found = plan.collectLeaves().iterator()
    while found.hasNext():
        leaf = found.next()
        kind, files = str(leaf.getClass().getSimpleName()).rstrip("$"), None
        if kind == "LogicalRelation" and str(leaf.relation().getClass().getSimpleName()) == "HadoopFsRelation":
            files = [str(f) for f in leaf.relation().location().inputFiles()]
        yield kind, files, str(leaf.schema().json())


def _listing(spark: SparkSession, files: list[str]) -> list[tuple[str, int, int]]:
    """Path, size and time of change of each file; folders are listed once each."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    wanted = {str(Path(f).toString()) for f in files}
    folders = {str(Path(f).getParent().toString()) for f in files}
    out = []
    for folder in sorted(folders):
        path = Path(folder)
        for s in path.getFileSystem(conf).listStatus(path):
            name = str(s.getPath().toString())
            if name in wanted:
                out.append((name, int(s.getLen()), int(s.getModificationTime())))
    return sorted(out)


def fingerprint(df: DataFrame, parameters: Mapping[str, object] | None = None) -> str:
    """What a result depends on, as a digest: its plan, its input files, its columns and ``parameters``.

    The plan is the analysed one in canonical form, so the same query written in a new session has the same
    digest. Of each input file the path, size and time of change count. Rows that only the session holds
    (made from Python objects or cached) and the code of Python functions are not seen by a plan: a query on
    such rows needs ``parameters`` that tell them apart, and without any it is an error.
    """
    plan = df._jdf.queryExecution().analyzed()
    inputs, held = [], set()
    for kind, files, columns in _sources(plan):
        if files is None and kind not in _COMPUTED:
            held.add(kind)
        inputs.append((kind, columns, _listing(df.sparkSession, files or [])))
    if held and not parameters:
        raise ValueError(f"rows of {', '.join(sorted(held))} are not files; name them by parameters")
    text = plan.canonicalized().treeString(True, False, _ALL, False, False)
    found = {"plan": text, "inputs": inputs, "columns": df.schema.json(), "parameters": dict(parameters or {})}
    return hashlib.sha256(json.dumps(found, sort_keys=True, default=str).encode()).hexdigest()[:32]


def rebuilt(df: DataFrame, path: str, parameters: Mapping[str, object] | None = None, keep_builds: int = 1) -> DataFrame:
    """The result of ``df``, read from ``path`` if it was made there from the same plan, files and parameters.

    Otherwise it is written to a folder of its own and published under its fingerprint by one rename, so
    a reader never sees half a result, and a writer that fails leaves the earlier one as it is. Two
    writers of the same result publish once. Builds other than the latest ``keep_builds`` are deleted then.
    """
    spark = df.sparkSession
    mark = fingerprint(df, parameters)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    target = Path(f"{path}/build-{mark}")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(Path(target, "_SUCCESS")):
        making = Path(f"{path}/_making-{uuid.uuid4().hex}")
        try:
            df.write.parquet(str(making.toString()))
            if not system.rename(making, target) and not system.exists(Path(target, "_SUCCESS")):
                raise OSError(f"could not publish {target.toString()}")
        finally:
            system.delete(making, True)
        # A rename onto a build that another writer has just published puts the new one inside it.
        system.delete(Path(target, making.getName()), True)
        builds = [s for s in system.listStatus(Path(path)) if str(s.getPath().getName()).startswith("build-")]
        for s in sorted(builds, key=lambda s: -s.getModificationTime()):
            if str(s.getPath().getName()) != str(target.getName()):
                keep_builds -= 1
                if keep_builds < 1:
                    system.delete(s.getPath(), True)
    return spark.read.schema(df.schema).parquet(str(target.toString()))
