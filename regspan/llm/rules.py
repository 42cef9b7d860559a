"""Quality rules as a short-circuit cascade, in DataFrame expressions only."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import keep
from .frames import SPACE, without, words_of

SYMBOLS = "#*$%&|<>"
# Rows, and files they are taken from, used to estimate cost and selectivity; they decide the order of the rules only.
SAMPLE_ROWS, SAMPLE_FILES = 1_000, 16


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def n_words(text: Column, words: Column) -> Column:
    return F.size(words).cast("long")


def word_chars(text: Column, words: Column) -> Column:
    """Code points in words."""
    return F.length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column, words: Column) -> Column:
    """Characters of ``[#*$%&|<>]``."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def n_dup_lines(text: Column, words: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(text: Column, words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text, the first included.

    Windows are compared by 64-bit hash. Texts without a repeated window are found with one hash
    set; in the others, sorting brings equal windows together, so the work is n log n.
    """

    def covered(found: Column) -> Column:
        ordered = F.sort_array(found)
        repeated = lambda x: F.filter(
            x, lambda e, k: (e["h"] == F.get(x, k - 1)["h"]) | (e["h"] == F.get(x, k + 1)["h"])
        )
        spread = lambda x: F.flatten(F.transform(x, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2)))
        return _let(ordered, lambda x: F.size(F.array_distinct(spread(repeated(x)))))

    n = F.size(words)
    found = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("i")),
    )
    some = _let(
        found, lambda x: F.when(F.size(F.array_distinct(x["h"])) == n - 2, F.lit(0)).otherwise(covered(x))
    )
    return F.when(n < 4, F.lit(0)).otherwise(some).cast("long")


def n_upper(text: Column, words: Column) -> Column:
    """Characters A-Z."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))).cast("long")


# Each from the text and its words, so that words are split once per document.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    f.__name__: f for f in (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper)
}

Measures = Mapping[str, Column]


@dataclass(frozen=True)
class Rule:
    """``fails`` gets the measures by name and says whether a document is rejected; never null."""

    name: str
    fails: Callable[[Measures], Column]


RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda m: m["n_words"] < 50),
    Rule("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", lambda m: 100 * m["n_symbols"] > 25 * m["n_words"]),
    Rule("short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
    Rule("long_words", lambda m: m["word_chars"] > 25 * m["n_words"]),
    Rule("repeated_lines", lambda m: 2 * m["n_dup_lines"] > m["n_words"]),
    Rule("upper_case", lambda m: 100 * m["n_upper"] > 30 * m["word_chars"]),
)
BASE = ("few_words", "repeated_words")


def measures_of(text: Column, words: Column) -> dict[str, Column]:
    return {name: f(text, words) for name, f in MEASURES.items()}


def with_measures(docs: DataFrame, text: str = "text", names: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    """``docs`` with a column for each of the named measures; input columns of any measure's name are replaced."""
    split = without(docs, [*MEASURES, "_words"]).withColumn("_words", words_of(F.col(text)))
    found = measures_of(F.col(text), F.col("_words"))
    return split.withColumns({n: found[n] for n in names}).drop("_words")


def _sample(docs: DataFrame, text: str, rows: int) -> DataFrame:
    """About ``rows`` texts with their words, written once.

    They are the first rows of files spread evenly over the table's; of a table made otherwise, its first rows.
    """
    files = sorted({unquote(f.rsplit("/", 1)[-1]) for f in docs.inputFiles()})
    step = -(-len(files) // SAMPLE_FILES) if files else 1
    chosen = files[::step]
    if len(chosen) > 1 and "_metadata" not in docs.columns:
        try:
            each = -(-rows // len(chosen))
            parts = [docs.where(F.col("_metadata.file_name") == f).select(text).limit(each) for f in chosen]
            some = reduce(DataFrame.union, parts)
        except AnalysisException:  # not the files' own rows
            some = docs.select(text).limit(rows)
    else:
        some = docs.select(text).limit(rows)
    return keep(some.coalesce(1).withColumn("_words", words_of(F.col(text))), "sample")


def estimate(
    docs: DataFrame, rules: Sequence[Rule], text: str, rows: int = SAMPLE_ROWS
) -> tuple[dict[str, float], dict[int, int]]:
    """Seconds of each rule over a sample, and how many rows fail which rules (as a bit mask).

    One job over the sample judges all rules of a row one after the other and reads the clock between
    them, so a rule's cost is what it adds to words that are split already, as in the cascade. The job is run twice;
    the second run, of compiled code, counts.
    """
    sample = _sample(docs, text, rows)
    clock = F.reflect(F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")
    found = measures_of(F.col(text), F.col("_words"))
    fields = [clock.alias("_t0")]
    for i, r in enumerate(rules):
        fields += [r.fails(found).cast("long").alias(f"_f{i}"), clock.alias(f"_t{i + 1}")]
    judged = sample.select(F.struct(*fields).alias("_s"))
    mask = sum((F.col(f"_s._f{i}") * (1 << i) for i in range(len(rules))), F.lit(0).cast("long"))
    spent = [F.sum(F.col(f"_s._t{i + 1}") - F.col(f"_s._t{i}")).alias(f"c{i}") for i in range(len(rules))]
    told = judged.groupBy(mask.alias("m")).agg(F.count(F.lit(1)).alias("n"), *spent)
    told.collect()
    groups = told.collect()
    cost = {r.name: max(sum(g[f"c{i}"] for g in groups) * 1e-9, 1e-6) for i, r in enumerate(rules)}
    return cost, {int(g.m): int(g.n) for g in groups}


def ordered(rules: Sequence[Rule], cost: Mapping[str, float], failed: Mapping[int, int]) -> list[Rule]:
    """Greedy order: next comes the rule that rejects most of the rows still there per second."""
    rest, out, left = list(enumerate(rules)), [], dict(failed)
    while rest:
        gain = lambda x: sum(n for m, n in left.items() if m >> x[0] & 1) / cost[x[1].name]
        best = max(rest, key=lambda x: (gain(x), -cost[x[1].name]))
        rest.remove(best)
        out.append(best[1])
        left = {m: n for m, n in left.items() if not m >> best[0] & 1}
    return out


def first_failure(rules: Sequence[Rule], measures: Measures) -> Column:
    """Name of the first rule that a document fails, else null; later rules are then not evaluated."""
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in rules:
        chain = chain.when(rule.fails(measures), F.lit(rule.name))
    return chain


def _verdict(order: Sequence[Rule], text: str) -> Column:
    return _let(words_of(F.col(text)), lambda words: first_failure(order, measures_of(F.col(text), words)))


def cascade(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", known: Mapping[str, str] | None = None
) -> DataFrame:
    """``docs`` with ``failed_rule``: the first rule failed in order of rejection per cost, null if none.

    The order comes from a sample (``estimate``) and may differ between runs; which documents
    fail any rule does not. ``known`` names the columns that already hold some measures; the others are
    computed for documents that reach a rule in need of them. A null or empty text has no words and fails; an empty table gives an empty result. An input column of the
    name ``failed_rule`` is replaced.
    """
    order = ordered(rules, *estimate(docs, rules, text))
    if known:
        value, columns = F.col(text), {n: F.col(c) for n, c in known.items()}
        failed = first_failure(order, measures_of(value, words_of(value)) | columns)
    else:
        failed = _verdict(order, text)
    return without(docs, ["failed_rule"]).withColumn("failed_rule", failed)


def passing(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents that fail no rule, with their own columns."""
    order = ordered(rules, *estimate(docs, rules, text))
    return docs.where(_verdict(order, text).isNull())
