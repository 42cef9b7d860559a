"""Mixing sources to target weights by systematic sampling, in DataFrame expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import keep
from .frames import without, word_count

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
# Documents of a source and size class are numbered in cells of about this many rows.
CELL_ROWS = 50_000

_OWN = ["_id", "_source", "_none", "_size", "_class", "_order", "_cell", "_n", "_before", "_rank", "_copies", "_digits"]


def _digits(rows: Column) -> Column:
    """Hexadecimal digits of the order hash that part ``rows`` rows into cells, one at least."""
    return F.greatest(F.lit(1), F.ceil(F.log(16.0, rows / CELL_ROWS))).cast("int")


def cell_starts(cells: DataFrame) -> DataFrame:
    """``cells`` (``_source``, ``_none``, ``_class``, ``_cell``, ``_n``) with ``_before``: the rows of the source before each.

    Sums run first over the classes of a source, a few hundred at most, then over the cells of a class, so no
    window sees the cells of a whole source.
    """
    classes = cells.groupBy("_source", "_none", "_class").agg(F.sum("_n").alias("_n"))
    upto = lambda *by: Window.partitionBy("_source", "_none", *by[:-1]).orderBy(by[-1])
    earlier = lambda *by: F.coalesce(
        F.sum("_n").over(upto(*by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    starts = classes.select("_source", "_none", "_class", earlier("_class").alias("_class_before"))
    within = cells.withColumn("_cell_before", earlier("_class", "_cell"))
    met = within.join(starts, ["_source", "_none", "_class"])
    return met.withColumn("_before", F.col("_class_before") + F.col("_cell_before")).drop("_class_before", "_cell_before")


def size_class(size: Column) -> Column:
    """Number of digits and the first two of them: grows with the size, in steps of at most a tenth."""
    digits = size.cast("string")
    return F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``target`` and ``rate`` (copies per document) of each source, given its ``_size``.

    Weights go round the sources by code point, null last. Filling stops at ``most`` times
    a source's size: with sources sorted by the level at which they are full, the common level
    is what the full ones leave, per weight of the others. One row per source meets in one task.
    """
    table = F.array(*[F.lit(w) for w in weights])
    by_name = Window.orderBy("_none", "_source")
    cap = F.col("_size") * most
    named = sources.withColumn("_w", table[F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))])
    by_level = Window.orderBy(cap / F.col("_w"), "_none", "_source")
    upto = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = named.withColumns(
        {
            "_left": F.sum("_size").over(whole) - F.coalesce(F.sum(cap).over(upto), F.lit(0)),
            "_weight": F.sum("_w").over(onward),
        }
    )
    # A source is full if the level over it and all later ones would pass its cap.
    full = F.col("_left") * F.col("_w") >= cap * F.col("_weight")
    state = filled.withColumn("_full", full)
    # The first source that is not full; among equal levels it has the most left.
    first = F.struct(cap / F.col("_w"), (-F.col("_left")).alias("_more"), "_left", "_weight")
    share = state.withColumn("_level", F.min(F.when(~F.col("_full"), first)).over(whole))
    target = F.when(F.col("_full"), cap.cast("double")).otherwise(
        (F.col("_level._left") * F.col("_w")).cast("double") / F.col("_level._weight").cast("double")
    )
    rate = F.when(F.col("_size") > 0, F.col("target") / F.col("_size")).otherwise(F.lit(0.0))
    found = share.withColumn("target", target).withColumn("_rate", rate)
    return found.select("_source", "_none", "_size", "target", "_rate")


def offset(source: Column, none: Column, seed: str) -> Column:
    """The source's random offset, a multiple of 2**-20 in [0, 1)."""
    key = F.concat(F.lit(f"{seed}/"), F.when(none, F.lit("-")).otherwise(F.concat(F.lit("+"), source)))
    return F.conv(F.substring(F.md5(key), 1, 5), 16, 10).cast("double") / F.lit(float(1 << 20))


def plan_mix(
    docs: DataFrame,
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (or some of its ``columns``) with ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    All sources together take as many words as there are. A document is expected
    ``target / source_size`` times; these numbers are summed up along its source, in order of size
    (to a tenth) and of a seeded hash of the id, from one random offset, and the document
    is taken once per whole number crossed. Documents of similar size are thus neighbours, which
    keeps a source's words near its target. A null text has size 0; a null id hashes like an
    empty one; rows that tie in all of it are alike, so reruns agree. Sources without words
    have target 0 and are not taken. An empty table gives an empty result. Input columns named like the new
    ones, or ``_source``, ``_size`` and so on, are dropped.

    A source of any share is numbered in cells of bounded size: sources are counted by class of size, large classes
    parted into cells, a cell's start is the sum of the earlier ones (over classes, then within the class), and rows are
    numbered within their cell. The one shuffle of documents is by cell.
    """
    new = ["size", "source_size", "target", "copies", "taken"]
    out = [c for c in (columns or docs.columns) if c.lower() not in {*new, *_OWN}]
    sized = docs.select(
        *out,
        F.coalesce(F.col(id).cast("string"), F.lit("")).alias("_id"),
        F.coalesce(F.col(source), F.lit("")).alias("_source"),
        F.col(source).isNull().alias("_none"),
        word_count(F.col(text)).alias("_size"),
    ).withColumns(
        {"_class": size_class(F.col("_size")), "_order": F.md5(F.concat(F.lit(f"{seed}:"), F.col("_id")))}
    )
    group = ["_source", "_none", "_class"]
    on = [*group, "_cell"]
    sized = sized.withColumn("_cell", F.substring("_order", 1, 1))
    cells = keep(sized.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_words")), "cells")
    sums = cells.groupBy("_source", "_none").agg(F.sum("_words").alias("_size"))
    goal = targets(sums, weights, most).withColumnsRenamed({"_size": "source_size"})
    # The cells of large classes are named by more digits of the order hash.
    classes = cells.groupBy(*group).agg(F.sum("_n").alias("_n"))
    parted = classes.select(*group, _digits(F.col("_n")).alias("_digits")).where("_digits > 1")
    if not parted.isEmpty():
        cell = F.expr("substring(_order, 1, coalesce(_digits, 1))")
        sized = sized.join(parted, group, "left").withColumn("_cell", cell).drop("_digits")
        cells = sized.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    starts = keep(cell_starts(cells).select(*on, "_before").join(goal, ["_source", "_none"]), "starts")
    within = Window.partitionBy(*on).orderBy("_order", "_size")
    rank = F.col("_before") + F.row_number().over(within)
    crossed = lambda r: F.floor(r * F.col("_rate") + offset(F.col("_source"), F.col("_none"), seed))
    # By cell, as the window needs it, whatever the number of cells.
    numbered = sized.join(starts.hint("merge"), on).withColumn("_rank", rank)
    copies = (crossed(F.col("_rank")) - crossed(F.col("_rank") - 1)).cast("long")
    return numbered.select(
        *out,
        F.col("_size").alias("size"),
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("_size")).alias("taken"),
    )


def mix(docs: DataFrame, copy: str = "copy", **options) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, ``copy`` counting from 0."""
    planned = plan_mix(docs, **options)
    copies = F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int")))
    some = without(planned.where("copies > 0"), [copy]).withColumn(copy, copies)
    return some.drop("size", "source_size", "target", "copies", "taken")
