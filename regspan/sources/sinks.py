"""Keeping results."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..session import own_folder


def materialise(df: DataFrame, path: str, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Write a named result as Parquet and read it back, which also cuts its lineage.

    ``cluster_by`` sorts within files so that later filters can skip row groups.
    """
    out = df.sortWithinPartitions(*cluster_by) if cluster_by else df
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result below the shared folder and read it back.

    Cuts the lineage, so a lost executor never costs more than the current step.
    ``regspan.session.release`` deletes everything kept by an application.
    """
    return materialise(df, f"{own_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}")

