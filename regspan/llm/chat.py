"""Chat formatting: logged snapshots of a conversation collapse into the longest one, then render.

DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import keep

# Turn numbers rendered into one row; a longer conversation gives several rows.
TURNS_PER_ROW = 1024
START, END = "<|im_start|>", "<|im_end|>"

_ID = ["_conv", "_none"]
_FIRST = -(2**63)


def _rows(turns: DataFrame, conv: str, turn: str, role: str, text: str, per_row: int) -> DataFrame:
    """Turns with the operator's own columns; a null turn number comes before all others."""
    zero = F.lit(0).cast(turns.schema[conv].dataType)
    at = F.coalesce(F.col(turn).cast("long"), F.lit(_FIRST))
    return turns.select(
        F.coalesce(F.col(conv), zero).alias("_conv"),
        F.col(conv).isNull().alias("_none"),
        at.alias("_at"),
        at.alias("_block"),
        F.col(role).cast("string").alias("_role"),
        F.col(text).alias("_text"),
    ).withColumn("_block", F.expr(f"(_at - pmod(_at, {per_row}L)) div {per_row}L"))


def _hash(seed: int) -> Column:
    """64 bits of a turn: its number, role and text, nulls told from empty texts."""
    nulls = [F.col(c).isNull() for c in ("_role", "_text")]
    return F.xxhash64(F.lit(seed), "_at", *nulls, "_role", "_text").cast("decimal(20,0)")


def prefix_hashes(rows: DataFrame) -> DataFrame:
    """Per conversation and turn: hashes ``_p1``, ``_p2`` and number ``_n`` of all rows up to that turn.

    ``_c`` counts the turn's own rows, ``_rank`` the turn numbers so far without a missing one.

    A rolling hash is the sum of the hashes of the turns so far, each of which contains the turn's
    number; two independent sums make 128 bits. Sums run within blocks of turn numbers; a block
    starts at the sum of the earlier blocks, so a conversation of any length is
    spread over tasks. ``_f1``, ``_f2``, ``_all`` belong to the whole conversation.
    """
    once = rows.select(*_ID, "_block", "_at", _hash(1).alias("_h1"), _hash(2).alias("_h2")).distinct()
    turns = once.groupBy(*_ID, "_block", "_at").agg(
        F.sum("_h1").alias("_h1"), F.sum("_h2").alias("_h2"), F.count(F.lit(1)).alias("_c")
    )
    turns = keep(turns.withColumn("_numbered", F.when(F.col("_at") == _FIRST, 0).otherwise(1)), "turns")
    sums = {"1": "_h1", "2": "_h2", "n": "_c", "r": "_numbered"}
    blocks = turns.groupBy(*_ID, "_block").agg(*[F.sum(c).alias(f"_b{k}") for k, c in sums.items()])
    order = Window.partitionBy(*_ID).orderBy("_block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = blocks.select(
        *_ID,
        "_block",
        *[F.coalesce(F.sum(f"_b{k}").over(earlier), F.lit(0)).alias(f"_s{k}") for k in sums],
        *[F.sum(f"_b{k}").over(every).alias(f"_t{k}") for k in sums],
    )
    upto = Window.partitionBy(*_ID, "_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    running = turns.select(*_ID, "_block", "_at", "_c", *[F.sum(c).over(upto).alias(f"_r{k}") for k, c in sums.items()])
    upto_here = {"1": "_p1", "2": "_p2", "n": "_n", "r": "_rank"}
    whole = {"1": "_f1", "2": "_f2", "n": "_all"}
    kinds = {"1": "decimal(38,0)", "2": "decimal(38,0)", "n": "long", "r": "long"}
    return running.join(starts, [*_ID, "_block"]).select(
        *_ID,
        "_at",
        "_c",
        *[(F.col(f"_r{k}") + F.col(f"_s{k}")).cast(kinds[k]).alias(c) for k, c in upto_here.items()],
        *[F.col(f"_t{k}").cast(kinds[k]).alias(c) for k, c in whole.items()],
    )


def maximal(prefixes: DataFrame) -> DataFrame:
    """Ids of the conversations that no longer one begins with; of equal ones the least id, null last."""
    print_ = ["_f1", "_f2", "_all"]
    least = F.min(F.struct("_none", "_conv")).alias("_id")
    whole = prefixes.where("_n = _all").groupBy(*print_).agg(least)
    begun = prefixes.where("_n < _all").select("_p1", "_p2", "_n").distinct().toDF(*print_)
    return whole.join(begun, print_, "left_anti").select("_id._conv", "_id._none")


def _plain(text: Column) -> Column:
    """Text in which the template's marks cannot occur."""
    return F.replace(F.replace(text, F.lit(START), F.lit("< |im_start|>")), F.lit(END), F.lit("< |im_end|>"))


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    per_row: int = TURNS_PER_ROW,
) -> DataFrame:
    """``conv``, ``first_turn``, ``n_turns`` and the rendered ``text`` of every maximal conversation.

    A conversation is dropped if all its turns (number, role and text) are the first turns of a
    longer one; of equal conversations the least id stays. A turn is rendered as its role and text
    between the marks ``<|im_start|>`` and ``<|im_end|>``, which are broken by a space where a text
    contains them. A conversation gives one row per ``per_row`` turn numbers that it has, whatever they
    are, and where turn numbers repeat, one per four times as many turns, in order; so no row or group
    grows without bound.

    Repeated rows count once. Different rows of one turn number are ordered by role and text. Turns
    without a number come first, in a row of their own with a null ``first_turn``; a null role reads
    ``unknown``, a null text is empty; all rows without a conversation id form one conversation. An
    empty table gives an empty result.
    """
    rows = _rows(turns, conv, turn, role, text, per_row)
    prefixes = keep(prefix_hashes(rows), "prefixes")
    # Turns without a number have a rank of 0 and a part of their own.
    parts = prefixes.withColumn("_part", F.floor((F.col("_rank") - 1) / per_row))
    # Many different rows of one turn number can overfill a part; it is then cut in order, by places counted
    # over the turn numbers before and then within the one at hand.
    earlier = Window.partitionBy(*_ID, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    counted = parts.withColumn("_before", F.coalesce(F.sum("_c").over(earlier), F.lit(0)))
    places = counted.select(*_ID, "_part", "_at", "_before").join(maximal(prefixes), _ID, "left_semi")
    within = F.dense_rank().over(Window.partitionBy(*_ID, "_at").orderBy("_role", "_text"))
    cut = F.floor((F.col("_before") + within - 1) / (4 * per_row))
    kept = rows.join(places, [*_ID, "_at"]).withColumn("_cut", cut)
    groups = kept.groupBy(*_ID, "_part", "_cut").agg(
        F.sort_array(F.collect_set(F.struct("_at", "_role", "_text"))).alias("_turns")
    )
    shown = F.transform(
        "_turns",
        lambda t: F.concat(
            F.lit(START), _plain(F.coalesce(t["_role"], F.lit("unknown"))), F.lit("\n"),
            _plain(F.coalesce(t["_text"], F.lit(""))), F.lit(f"{END}\n"),
        ),
    )
    first = F.col("_turns")[0]["_at"]
    return groups.select(
        F.when(~F.col("_none"), F.col("_conv")).alias(conv),
        F.when(first != _FIRST, first).alias("first_turn"),
        F.size("_turns").cast("long").alias("n_turns"),
        F.array_join(shown, "").alias("text"),
    )
