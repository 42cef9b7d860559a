"""Operators on dispensed prescriptions: hypertension and treatment periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import LAST_DAY
from ..functions.codes import (
    Conditions,
    condition_lists,
    matched_conditions,
    matches,
    shortest_prefixes,
    starts_with_any,
    valid_id,
)
from ..functions.dates import quarter_index


def hypertension_at(
    rx: DataFrame,
    index: DataFrame,
    classes: Conditions,
    id: str = "pnr",
    atc: str = "atc",
    date: str = "eksd",
    index_date: str = "index_date",
    days: int = 180,
    needed: int = 2,
) -> DataFrame:
    """``(id, index_date, n_classes, hypertension)`` for every id and date of ``index``.

    Our rule: 1 when at least two distinct classes were dispensed in the 180
    days before the index date (the date itself not included), else 0. A class
    counts if its latest day before the index date is recent enough, so days
    and index dates are walked once per person instead of being paired.
    Persons without an index date cost a share of that walk; cut ``rx`` to the
    cohort first where they are most of it.
    """
    lists = condition_lists(classes)
    wanted = starts_with_any(F.col(atc), [p for ps in lists.values() for p in ps])
    bought = rx.where(wanted & F.col(date).isNotNull()).select(
        id,
        F.col(date).alias("_day"),
        F.lit(False).alias("_index"),
        *[F.coalesce(matches(F.col(atc), p), F.lit(False)).alias(f"_c_{n}") for n, p in lists.items()],
    )
    asked = index.where(valid_id(F.col(id)) & F.col(index_date).isNotNull()).select(
        id, F.col(index_date).alias("_day"), F.lit(True).alias("_index"),
        *[F.lit(False).alias(f"_c_{n}") for n in lists],
    )
    flags = ["_index", *[f"_c_{n}" for n in lists]]
    daily = bought.unionByName(asked).groupBy(id, "_day").agg(*[F.max(f).alias(f) for f in flags])
    before = Window.partitionBy(id).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    latest = [F.max(F.when(F.col(f"_c_{n}"), F.col("_day"))).over(before) for n in lists]
    recent = [F.coalesce(d >= F.date_sub(F.col("_day"), days), F.lit(False)).cast("long") for d in latest]
    return (
        daily.withColumn("n_classes", sum(recent[1:], recent[0]))
        .where("_index")
        .select(
            id,
            F.col("_day").alias(index_date),
            "n_classes",
            (F.col("n_classes") >= needed).cast("int").alias("hypertension"),
        )
    )


def hypertension_first(
    rx: DataFrame,
    classes: Conditions,
    id: str = "pnr",
    atc: str = "atc",
    date: str = "eksd",
    needed: int = 2,
) -> DataFrame:
    """``(id, hypertension_date)`` for ids that ever qualify.

    Our rule: a quarter qualifies when at least two distinct classes are
    dispensed in it. The date is the day in the second of two consecutive
    qualifying quarters on which its second class appears; the earliest such
    day per id, so that nothing after the date is used.
    """
    by_class = (
        _class_days(rx, id, atc, date, classes)
        .groupBy(id, quarter_index(F.col(date)).alias("quarter"), "drug_class")
        .agg(F.min(date).alias("first_day"))
    )
    # One element per class: the group is as long as the class list at most.
    quarters = (
        by_class.groupBy(id, "quarter")
        .agg(F.sort_array(F.collect_list("first_day")).alias("first_days"))
        .select(id, "quarter", F.get("first_days", F.lit(needed - 1)).alias("second_day"))
        .where(F.col("second_day").isNotNull())
    )
    person = Window.partitionBy(id).orderBy("quarter")
    return (
        quarters.withColumn("_previous", F.lag("quarter").over(person))
        .where(F.col("quarter") - F.col("_previous") == 1)
        .groupBy(id)
        .agg(F.min("second_day").alias("hypertension_date"))
    )


def _class_days(rx: DataFrame, id: str, atc: str, date: str, classes: Conditions) -> DataFrame:
    prefixes = [p for ps in condition_lists(classes).values() for p in ps]
    hits = F.explode(matched_conditions(F.col(atc), classes))
    wanted = starts_with_any(F.col(atc), prefixes) & F.col(date).isNotNull()
    return rx.where(wanted).select(id, date, hits.alias("drug_class"))


# A depot lasts to the end of the calendar at most.
CALENDAR_DAYS = 3_652_059
# Finished purchases per batch of the fold.
BATCH = 128


@dataclass(frozen=True)
class Drug:
    """How one drug is taken: code prefixes, default daily dose by strength, limits.

    A strength without a default dose counts as one tablet a day.
    """

    prefixes: Sequence[str]
    default_doses: Mapping[float, float] = field(default_factory=dict)
    min_dose: float = 1e-6
    max_dose: float = 1e9
    max_depot: float = 1e9
    n_prev: int = 3

    def __post_init__(self):
        if not 0 < self.min_dose <= self.max_dose or self.n_prev < 1 or self.max_depot < 0:
            raise ValueError(f"impossible limits: {self}")


def _by_drug(drugs: Mapping[str, Drug], value) -> Column:
    pairs = [F.lit(x) for name, drug in drugs.items() for x in (name, value(drug))]
    return F.create_map(*pairs)[F.col("drug")]


def _default_dose(drugs: Mapping[str, Drug]) -> Column:
    out = F.col("strength")
    for name, drug in drugs.items():
        for strength, dose in drug.default_doses.items():
            known = (F.col("drug") == name) & (F.col("strength") == F.lit(float(strength)))
            out = F.when(known, F.lit(float(dose))).otherwise(out)
    return out


def daily_purchases(
    rx: DataFrame, drugs: Mapping[str, Drug], id: str, atc: str, date: str,
    packages: str, tablets: str, strength: str,
) -> DataFrame:
    """``(id, drug, date, amount, strength)``: one row per id, drug and day.

    The amount is the day's total, exact to 6 decimals whatever the order of rows; the strength
    is its largest.
    """
    lists = {name: list(drug.prefixes) for name, drug in drugs.items()}
    wanted = starts_with_any(F.col(atc), shortest_prefixes(p for ps in lists.values() for p in ps))
    amount = F.col(packages).cast("double") * F.col(tablets) * F.col(strength)
    rows = rx.where(wanted & F.col(date).isNotNull()).select(
        id,
        F.col(date).alias("date"),
        F.round(amount, 6).cast("decimal(28,6)").alias("amount"),
        F.col(strength).cast("double").alias("strength"),
        F.explode(matched_conditions(F.col(atc), lists)).alias("drug"),
    )
    return rows.groupBy(id, "drug", "date").agg(
        F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)).alias("amount"),
        F.max("strength").alias("strength"),
    )


def treatment_periods(
    rx: DataFrame,
    drugs: Mapping[str, Drug],
    id: str = "pnr",
    atc: str = "atc",
    date: str = "eksd",
    packages: str = "apk",
    tablets: str = "packsize",
    strength: str = "strnum",
    merge: bool = False,
) -> DataFrame:
    """Treatment periods ``(id, drug, start, end, dose)`` from purchases.

    Our rule, using only the past at any date. Purchases of one day are one.
    What is left at a purchase is the depot less the dose for each day passed,
    between 0 and ``max_depot``. If the depot ran out before the purchase, or
    there was none before, a new run starts with the default dose of the day's
    largest strength. Otherwise the dose is the amount bought divided by the
    days it lasted over the last ``n_prev`` purchases of the run, within
    ``min_dose`` and ``max_dose``. A period ends when the depot is empty or at
    the next purchase, on 9999-12-31 at the latest. Doses are rounded to 6 decimals; ``merge`` joins
    touching periods of equal dose.
    """
    daily = daily_purchases(rx, drugs, id, atc, date, packages, tablets, strength)
    purchase = F.struct("date", "amount", F.greatest(_default_dose(drugs), F.lit(1e-6)).alias("start_dose"))
    # At most one element per day: bounded by the calendar, also for a heavy buyer.
    history = daily.groupBy(id, "drug").agg(F.array_sort(F.collect_list(purchase)).alias("_buys"))
    limits = {
        "_min": _by_drug(drugs, lambda d: float(d.min_dose)),
        "_max": _by_drug(drugs, lambda d: float(d.max_dose)),
        "_cap": _by_drug(drugs, lambda d: float(d.max_depot)),
        "_n_prev": _by_drug(drugs, lambda d: int(d.n_prev)),
    }
    periods = history.withColumns(limits).withColumn("_periods", _dosed())
    spell = F.transform(
        F.col("_periods"),
        lambda p, i: F.struct(
            p["date"].alias("start"),
            F.least(
                F.date_add(p["date"], p["days"]), F.get(F.col("_periods"), i + 1)["date"],
                F.lit(LAST_DAY).cast("date"),
            ).alias("end"),
            F.round(p["dose"], 6).alias("dose"),
        ),
    )
    out = (
        periods.select(id, "drug", F.explode(spell).alias("_p"))
        .select(id, "drug", "_p.start", "_p.end", "_p.dose")
        .where(F.col("start") < F.col("end"))
    )
    return _merged(out, id) if merge else out


def _lasting(depot: str, dose: str) -> str:
    """Whole days a depot lasts, as many as the calendar has at most."""
    return f"int(least(floor({depot} / {dose}), {CALENDAR_DAYS}))"


def _dosed() -> Column:
    """Fold ``_buys`` in date order to an array of (date, dose, whole days the depot lasts).

    Finished purchases are kept in batches, so that appending stays cheap over
    a long history.
    """
    buys = "array<struct<amount: double, days: int>>"
    done = "array<struct<date: date, dose: double, days: int>>"
    start = f"""named_struct(
        'date', date(null), 'amount', 0D, 'depot', 0D, 'dose', 1D, 'run', cast(array() AS {buys}),
        'batch', cast(array() AS {done}), 'batches', cast(array() AS array<{done}>))"""
    passed = "datediff(buy.date, s.date)"
    fresh = f"coalesce({_lasting('s.depot', 's.dose')} < {passed}, true)"
    # What the purchase finds: the depot left, and the run of purchases it continues (null: none).
    found = f"""named_struct(
        'left', if({fresh}, 0D, least(_cap, greatest(0D, s.depot - s.dose * {passed}))),
        'run', if({fresh}, null, slice(
            concat(s.run, array(named_struct('amount', s.amount, 'days', {passed}))),
            greatest(size(s.run) + 2 - _n_prev, 1), _n_prev)))"""
    mean = """aggregate(f.run, 0D, (a, x) -> a + x.amount)
              / nullif(aggregate(f.run, 0, (a, x) -> a + x.days), 0)"""
    dosed = f"""named_struct(
        'depot', f.left + buy.amount,
        'dose', if(f.run IS NULL, buy.start_dose, least(_max, greatest(_min, {mean}))),
        'run', coalesce(f.run, cast(array() AS {buys})))"""
    this = f"""array(named_struct(
        'date', buy.date, 'dose', n.dose, 'days', {_lasting('n.depot', 'n.dose')}))"""
    full = f"size(s.batch) >= {BATCH}"
    after = f"""named_struct(
        'date', buy.date, 'amount', buy.amount, 'depot', n.depot, 'dose', n.dose, 'run', n.run,
        'batch', if({full}, {this}, concat(s.batch, {this})),
        'batches', if({full}, concat(s.batches, array(s.batch)), s.batches))"""
    # Lambdas over one element name an intermediate result, so that it is computed once
    # (transform copies its results, so the growing state is only passed through aggregate).
    step = f"aggregate(transform(array({found}), f -> {dosed}), s, (s, n) -> {after})"
    end = "flatten(concat(s.batches, array(s.batch)))"
    return F.expr(f"aggregate(_buys, {start}, (s, buy) -> {step}, s -> {end})")


def _merged(periods: DataFrame, id: str) -> DataFrame:
    person = Window.partitionBy(id, "drug").orderBy("start")
    goes_on = (F.col("start") == F.lag("end").over(person)) & (F.col("dose") == F.lag("dose").over(person))
    opens = F.coalesce(~goes_on, F.lit(True)).cast("int")
    return (
        periods.withColumn("_opens", opens)
        .withColumn("_run", F.sum("_opens").over(person.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(id, "drug", "_run", "dose")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select(id, "drug", "start", "end", "dose")
    )
