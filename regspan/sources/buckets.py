"""Registers kept in buckets of persons, so that they meet by person without a shuffle."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

_SPEC = "_buckets.json"


def _spec_file(spark: SparkSession, path: str):
    file = spark._jvm.org.apache.hadoop.fs.Path(path, _SPEC)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()), file


def save_bucketed(df: DataFrame, path: str, buckets: int, by: str = "pnr") -> DataFrame:
    """Write a register to ``path`` in ``buckets`` buckets by person, sorted within them, and read it back.

    Rows are dealt to the buckets by one shuffle, so a bucket is one file. A note beside the files tells ``read_bucketed``
    in later sessions how they are dealt. Numbers of buckets that divide each other are best: a join
    then uses the smaller one (``spark.sql.bucketing.coalesceBucketsInJoin.enabled``, up to four to one).
    """
    spark = df.sparkSession
    name = f"regspan_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, by).write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, by).sortBy(by).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # its files stay
    system, file = _spec_file(spark, path)
    out = system.create(file, True)
    out.write(bytearray(json.dumps({"buckets": buckets, "by": by, "schema": df.schema.json()}).encode()))
    out.close()
    return read_bucketed(spark, path)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A register written by ``save_bucketed``: joins and aggregates by person need no shuffle.

    The folder is made known to the session's catalog under a name of its own.
    """
    system, file = _spec_file(spark, path)
    with_spec = system.open(file)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(with_spec, "UTF-8")
    with_spec.close()
    spec = json.loads(text)
    full = str(system.makeQualified(file.getParent()).toString())
    name = "regspan_" + hashlib.md5(f"{full}\n{text}".encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        from pyspark.sql.types import StructType

        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(spec["schema"])))
        location = full.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{spec['by']}`)"
            f" SORTED BY (`{spec['by']}`) INTO {spec['buckets']} BUCKETS LOCATION '{location}'"
        )
    return spark.table(name)
