"""Reading registers."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import list_periods


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def read_register(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One directory dataset, lower-case names, listed columns only."""
    df = lower_names(spark.read.parquet(path))
    return df if columns is None else df.select(*[c.lower() for c in columns])


def append(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all tables, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_periods(
    spark: SparkSession,
    folder: str,
    pattern: str,
    columns: Sequence[str] | None = None,
    types: Mapping[str, str] | None = None,
    period: str | None = None,
    year_pattern: str = r"^\D*(\d{4})",
) -> DataFrame:
    """One table from a register kept as one directory per period.

    Directories whose name matches ``pattern`` are chosen before anything is
    read. The schemas of all their files are merged by one Spark job and the files read
    by one scan; a column missing from some files is null there. Only where types
    differ are schemas looked at directory by directory. A column whose type differs between years must
    be given a type in ``types`` (cast strictly, so a bad value is an error rather
    than a silent null under Spark's ANSI mode); types that differ within one directory are an error.
    ``period`` adds the year in the directory name as an integer column.
    """
    chosen = list_periods(spark, folder, pattern)
    if not chosen:
        raise FileNotFoundError(f"nothing in {folder} matches {pattern!r}")
    wanted = None if columns is None else {c.lower() for c in columns}
    types = {c.lower(): t for c, t in (types or {}).items()}

    # Period directories of equal schema are one scan.
    groups: dict[tuple, list[str]] = defaultdict(list)
    schemas = {}
    for paths, schema in _schemas(spark, list(chosen.values())):
        fields = tuple((f.name, f.dataType.simpleString()) for f in schema)
        groups[fields].extend(paths)
        schemas[fields] = schema
    seen: dict[str, set[str]] = defaultdict(set)
    for columns_of_group in groups:
        for name, kind in columns_of_group:
            if name.lower() not in types and (wanted is None or name.lower() in wanted):
                seen[name.lower()].add(kind)
    mixed = {n: sorted(k) for n, k in seen.items() if len(k) > 1}
    if mixed:
        raise TypeError(f"types differ between periods, declare them: {mixed}")

    frames = []
    for fields, paths in groups.items():
        df = spark.read.schema(schemas[fields]).parquet(*paths)
        kept = [n for n, _ in fields if wanted is None or n.lower() in wanted]
        out = [
            (F.col(n).cast(types[n.lower()]) if n.lower() in types else F.col(n)).alias(n.lower())
            for n in kept
        ]
        if period:
            out.append(period_from_path(year_pattern).alias(period))
        frames.append(df.select(*out))
    table = append(frames)
    missing = sorted((wanted or set()) - {c.lower() for c in table.columns})
    if missing:
        raise ValueError(f"in no period: {', '.join(missing)}")
    order = [c.lower() for c in columns] if columns is not None else [c for c in table.columns if c != period]
    return table.select(*order, *([period] if period else []))


def _merged_schema(spark: SparkSession, paths: Sequence[str]) -> StructType | None:
    """The schema of all files together, found by one job; None if types differ."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as err:
        if "CANNOT_MERGE" in str(err):
            return None
        raise


def _schemas(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], StructType]]:
    """All paths with one schema if it merges, else each path with its own."""
    together = _merged_schema(spark, paths)
    if together is not None:
        return [(paths, together)]
    out = []
    for path in paths:
        schema = _merged_schema(spark, [path])
        if schema is None:
            raise TypeError(f"types differ between the files of {path}")
        out.append(([path], schema))
    return out


def period_from_path(year_pattern: str = r"^\D*(\d{4})") -> Column:
    """The year in the name of the directory a row was read from."""
    directory = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    # The path is percent-encoded, where a plus sign stands for itself.
    name = F.url_decode(F.replace(directory, F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(name, year_pattern, 1).cast("int")


def select_prefix(df: DataFrame, keep: Sequence[str], prefix: str) -> DataFrame:
    """Listed columns and all whose name starts with a prefix, in lower case."""
    more = [c for c in df.columns if c.lower().startswith(prefix.lower())]
    return lower_names(df.select(*keep, *more))


def extract(
    df: DataFrame,
    keep: Sequence[str] | None = None,
    where: Column | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Cut a register to rows and columns; the row cap comes last, ``None`` is no cap."""
    out = df if where is None else df.where(where)
    out = out if keep is None else out.select(*keep)
    return out if rows is None else out.limit(rows)


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row with the number of values per column that a cast would lose."""
    return df.agg(
        *[
            F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), 1)).alias(c)
            for c, t in types.items()
        ]
    )
