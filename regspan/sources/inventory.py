"""What registers there are and what is in them."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import list_names

_RANGED = ("int", "bigint", "smallint", "tinyint", "double", "float", "date", "string")


MEASURES = ("rows", "non_null", "distinct", "least", "greatest")


def dataset_contents(df: DataFrame, dataset: str = "", measures: Sequence[str] = MEASURES) -> DataFrame:
    """One row per column: type and the ``measures`` asked for, no others are computed.

    They are the rows, non-null and distinct values, and the least and greatest value as text. One aggregate over
    the table; distinct counts are approximate. Least and greatest are null where a type has no order
    worth showing.
    """
    unknown = set(measures) - set(MEASURES)
    if unknown:
        raise ValueError(f"unknown measures: {sorted(unknown)}")
    per_column = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        ranged = kind.startswith(("decimal", "timestamp")) or kind in _RANGED
        flat = ranged or kind in ("boolean", "binary")
        found = {
            "rows": F.count(F.lit(1)),
            "non_null": F.count(c),
            "distinct": F.approx_count_distinct(c) if flat else F.lit(None).cast("long"),
            "least": F.min(c).cast("string") if ranged else F.lit(None).cast("string"),
            "greatest": F.max(c).cast("string") if ranged else F.lit(None).cast("string"),
        }
        names = F.lit(field.name).alias("column"), F.lit(kind).alias("type")
        per_column.append(F.struct(*names, *[found[m].alias(m) for m in measures]))
    one_row = df.agg(F.array(*per_column).alias("_columns"))
    return one_row.select(F.lit(dataset).alias("dataset"), F.explode("_columns").alias("_c")).select(
        "dataset", "_c.*"
    )


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Every column of every Parquet dataset in a folder, with its row count.

    Columns and types come from the files' schemas; the rows are counted by Spark.
    """
    tables = []
    for name, path in list_names(spark, root).items():
        df = spark.read.parquet(path)
        columns = F.array(
            *[
                F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"))
                for f in df.schema.fields
            ]
        )
        counted = df.agg(F.count(F.lit(1)).alias("rows"))
        tables.append(
            counted.select(F.lit(name.removesuffix(".parquet")).alias("dataset"), F.explode(columns).alias("_c"), "rows")
            .select("dataset", "_c.column", "_c.type", "rows")
        )
    if not tables:
        raise FileNotFoundError(f"no datasets in {root}")
    return reduce(DataFrame.unionByName, tables)


def dataset_of(path: str, root: str) -> str:
    """The dataset of a file, as a path below ``root`` without the ending ``.parquet``.

    Part files belong to the nearest folder above them that is not ``key=value``; any other file is
    a dataset by itself.
    """
    parts = path.removeprefix(root).strip("/").split("/")
    if parts[-1].startswith("part"):
        parts = parts[:-1]
        while parts and "=" in parts[-1]:
            parts.pop()
    return "/".join(parts).removesuffix(".parquet")


def _footers(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    """One row per file and column, from the files' last bytes."""
    import pyarrow.fs
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type

    for batch in batches:
        found: list[tuple] = []
        for path in batch.column("path").to_pylist():
            uri = quote(re.sub("^file:/+", "file:///", path), safe="/:@=+,;$&")
            system, name = pyarrow.fs.FileSystem.from_uri(uri)
            meta = pq.read_metadata(name, filesystem=system)
            for field in meta.schema.to_arrow_schema():
                kind = from_arrow_type(field.type, prefer_timestamp_ntz=True).simpleString()
                found.append((dataset_of(path, root), field.name, kind, meta.num_rows))
        columns = list(zip(*found)) or [()] * 4
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["dataset", "column", "type", "rows"]
        )


def project_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Every column of every Parquet dataset anywhere below ``root``.

    One row per dataset, column and type: the ``rows`` and ``files`` that have it, so a column whose type
    differs between files, or that some lack, shows. Datasets are named by their path below
    ``root``; folders named ``key=value`` belong to the dataset above them and are no columns here.

    Spark lists the tree, and tasks read the files' footers with pyarrow: no rows are read, and one job
    does for any number of datasets. The store has to be one that pyarrow opens (local, HDFS, S3, GCS, Azure).
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = str(path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString())
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    found = files.load(root).select("path").mapInArrow(
        lambda it: _footers(it, full), "dataset string, column string, type string, rows long"
    )
    return found.groupBy("dataset", "column", "type").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"))
