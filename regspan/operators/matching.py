"""Incidence- and exposure-density matching.

For a case at date t the candidates are the persons of its stratum whose time
at risk ``[entry, exit)`` holds t. Listing them per case would grow with cases
times stratum size, so controls are drawn by number instead:

* time is cut into blocks of 1, 2, 4, … days; each time at risk is the union of
  a few such blocks (two per block size at most), and t lies in exactly one
  block of each size, so every candidate is found in exactly one block of t;
* within stratum and block, persons are numbered in a seeded random order;
* the block counts give the exact number of candidates C of a case, k distinct
  numbers below C are drawn from the seed, and each is looked up by an equi join.

Work grows with persons times block sizes plus cases times k. The draw is a
simple random sample without replacement from the whole risk set.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import DAY_BITS, blocks, blocks_of_day, day_number

# A block's persons are numbered in this many parts (2 ** bits), so that a
# large stratum is numbered by many tasks.
PART_BITS = 10
_HASH_DIGITS = 15


def _hash(*parts: Column) -> Column:
    """A 60-bit number from text."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _HASH_DIGITS), 16, 10).cast("long")


def _merged(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """An inner join by shuffle and sort, never by broadcast.

    Spark takes a frame for as small as the file it stems from, however many
    rows explode() makes of it, and would build these through the driver.
    """
    return left.join(right.hint("merge"), on)


def _numbered(
    at_risk: DataFrame, block: list[str], wanted: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Rows of the wanted blocks (distinct) with their number (from 0) in the seeded order of
    their block, and block counts."""
    in_part = Window.partitionBy(*block, "_part").orderBy("_order", "_person")
    bits = 4 * _HASH_DIGITS - PART_BITS
    ranked = at_risk.withColumn("_part", F.shiftright("_order", bits).cast("int"))
    ranked = ranked.withColumn("_in_part", F.row_number().over(in_part))
    # Persons are shuffled once: the sizes come from the same numbering.
    sizes = ranked.groupBy(*block, "_part").agg(F.max("_in_part").alias("_size"))
    # Sizes, not rows, meet the wanted blocks: of them a block has 2 ** PART_BITS at most. Spark
    # would push a semi join down to the rows and shuffle these twice.
    sizes = _merged(sizes, wanted, block)
    before = Window.partitionBy(*block).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    counts = offsets.groupBy(*block).agg(F.max(F.col("_offset") + F.col("_size")).alias("_n"))
    number = F.col("_offset") + F.col("_in_part") - 1
    numbered = _merged(ranked, offsets, [*block, "_part"]).select(
        *block, number.alias("_number"), "_person"
    )
    return numbered, counts


def _draw(k: int, seed: int) -> Column:
    """k distinct numbers below ``_available`` (all of them if there are fewer).

    Floyd's method: for m = available-k, …, available-1 take a random number
    up to m, or m itself if that number is already taken.
    """
    taken = f"least({k}L, _available)"
    top = f"(_available - {taken} + turn)"
    text = f"concat_ws('|', '{seed}', string(case_id), string(turn))"
    number = f"(bigint(conv(substring(md5({text}), 1, {_HASH_DIGITS}), 16, 10)) % ({top} + 1))"
    return F.expr(
        f"""aggregate(
              sequence(0L, {taken} - 1),
              cast(array() AS array<bigint>),
              (chosen, turn) -> concat(chosen, array(
                if(array_contains(chosen, {number}), {top}, {number}))))"""
    )


def _match(
    df: DataFrame,
    match_date: str,
    leaves: Sequence[str],
    k: int,
    strata: Sequence[str],
    seed: int,
    id: str,
    entry: str,
) -> DataFrame:
    if k < 1:
        raise ValueError("k must be at least 1")
    strata = list(strata) or ["_all"]
    if strata == ["_all"]:
        df = df.withColumn("_all", F.lit(0))
    block = [*strata, "_bits", "_block"]
    last_day = F.lit(1 << DAY_BITS)

    cases = df.where(F.col(match_date).isNotNull()).select(
        F.col(id).alias("case_id"), *strata, F.col(match_date).alias("match_date")
    )
    # A missing stratum matches nobody.
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in strata])
    # Non-null keys need no filters of their own, so that equal subplans stay
    # equal and their shuffles are done once.
    keys = [F.coalesce(F.col(f"_b.{c}"), F.lit(-1)).alias(f"_{c}") for c in ("bits", "block")]

    # Strata and dates of cases: at most strata x days rows.
    points = cases.where(known).select(*strata, "match_date").distinct()
    around = points.withColumn("_day", day_number(F.col("match_date")))
    around = around.select(*strata, "match_date", F.explode(blocks_of_day("_day")).alias("_b"))
    around = around.select(*strata, "match_date", *keys)

    exit_day = F.coalesce(F.least(*[day_number(F.col(c)) for c in leaves], last_day), last_day)
    low = F.greatest(day_number(F.col(entry)), F.lit(0))
    at_risk = (
        df.where(F.col(entry).isNotNull() & known)
        .select(
            F.col(id).alias("_person"),
            *strata,
            F.coalesce(_hash(F.lit(seed), F.col(id)), F.lit(0)).alias("_order"),
            low.alias("_low"),
            F.greatest(exit_day, F.lit(0)).alias("_high"),
        )
        .select("_person", *strata, "_order", F.explode(blocks("_low", "_high")).alias("_b"))
        .select("_person", *strata, "_order", *keys)
    )
    # Only blocks around some case matter.
    people, counts = _numbered(at_risk, block, around.select(*block).distinct())

    # One element per block size.
    choices = (
        _merged(around, counts, block)
        .groupBy(*strata, "match_date")
        .agg(
            F.sum("_n").alias("_available"),
            F.array_sort(
                F.collect_list(
                    F.struct(
                        F.col("_bits").alias("bits"), F.col("_block").alias("block"),
                        F.col("_n").alias("n"),
                    )
                )
            ).alias("_choices"),
        )
    )
    draws = (
        _merged(cases, choices, [*strata, "match_date"])
        .select("*", F.posexplode(_draw(k, seed)).alias("_turn", "_pick"))
        .withColumn("_found", F.expr(_LOCATED))
        .select(
            "case_id", *strata, "match_date",
            (F.col("_turn") + 1).alias("rank"),
            *[
                F.coalesce(F.col(f"_found.{c}"), F.lit(-1)).alias(f"_{c}")
                for c in ("bits", "block", "number")
            ],
        )
    )
    controls = _merged(draws, people, [*block, "_number"])
    shown = [c for c in strata if c != "_all"]
    columns = ["case_id", F.col("_person").alias("id"), *shown, "match_date", "rank"]
    as_rank0 = cases.select(
        "case_id", F.col("case_id").alias("id"), *shown, "match_date", F.lit(0).alias("rank")
    )
    return as_rank0.unionByName(controls.select(*columns))


# The block that holds the number ``_pick``, counting through the blocks of a case.
_LOCATED = """aggregate(
    _choices,
    named_struct('bits', -1, 'block', -1, 'number', _pick),
    (at, c) -> CASE
      WHEN at.bits >= 0 THEN at
      WHEN at.number < c.n THEN named_struct('bits', c.bits, 'block', c.block, 'number', at.number)
      ELSE named_struct('bits', at.bits, 'block', at.block, 'number', at.number - c.n) END)"""


def incidence_match(
    df: DataFrame,
    k: int,
    strata: Sequence[str] = (),
    seed: int = 1,
    id: str = "id",
    entry: str = "entry",
    end: str = "end",
    case_date: str = "case_date",
) -> DataFrame:
    """k controls per case from those at risk at the case date.

    Input: one row per person; ``case_date`` null for non-cases. Our rule: a
    control has the case's strata, entry ≤ t, end of follow-up > t (null: open)
    and no event on or before t. A later case may serve as control, and a
    person may serve several cases. Output ``(case_id, id, strata…,
    match_date, rank)``: the case with rank 0, its controls from 1. Cases with
    fewer than k candidates get all of them. Equal seeds give equal results.
    """
    return _match(df, case_date, [end, case_date], k, strata, seed, id, entry)


def exposure_match(
    df: DataFrame,
    k: int,
    strata: Sequence[str] = (),
    seed: int = 1,
    id: str = "id",
    entry: str = "entry",
    end: str = "end",
    case_date: str = "case_date",
    exposure_date: str = "exposure_date",
) -> DataFrame:
    """As ``incidence_match``, for exposed persons at their exposure date.

    A control is alive, event-free and not yet exposed on that date.
    """
    leaves = [end, case_date, exposure_date]
    return _match(df, exposure_date, leaves, k, strata, seed, id, entry)


def match_report(matched: DataFrame) -> DataFrame:
    """``(measure, key, n)``: how matching went and how often persons were reused.

    ``controls_per_case``: cases by number of controls found; ``times_used``:
    controls by number of cases served; ``case_and_control``: persons in both
    roles (no row if there are none).
    """
    control, case = (F.col("rank") > 0).cast("long"), (F.col("rank") == 0)
    roles = F.explode(
        F.array(
            F.struct(F.lit(True).alias("as_case"), F.col("case_id").alias("who")),
            F.struct(F.lit(False).alias("as_case"), F.col("id").alias("who")),
        )
    )
    people = (
        matched.select(roles.alias("_r"), control.alias("control"), case.alias("case"))
        .groupBy("_r.as_case", "_r.who")
        .agg(F.sum("control").alias("controls"), F.max("case").alias("is_case"))
    )

    def entry(measure: str, wanted: Column, key: Column) -> Column:
        return F.when(wanted, F.struct(F.lit(measure).alias("measure"), key.alias("key")))

    used = ~F.col("as_case") & (F.col("controls") > 0)
    entries = F.array_compact(
        F.array(
            entry("controls_per_case", F.col("as_case"), F.col("controls")),
            entry("times_used", used, F.col("controls")),
            entry("case_and_control", used & F.col("is_case"), F.lit(1).cast("long")),
        )
    )
    return (
        people.select(F.explode(entries).alias("_e"))
        .groupBy("_e.measure", "_e.key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
