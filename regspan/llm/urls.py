"""URL filters: host and path rules, and trust spread over the link graph of hosts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import keep

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Up to so many rules become one expression; more are met by joins.
LITERAL_RULES = 200
DAMPING = 0.85
ITERATIONS = 20
# Distrust must exceed trust by this to block a host. A host all of whose pages are blocked by rules has a distrust
# of at least 1; any number of hosts that link to such hosts only get at least 0.85, one that does so by half of its
# links about half of that.
MARGIN = 0.5
# Iterations between two written tables.
WRITE_EVERY = 5


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, text: str) -> Rule:
        """From ``allow example.org/es/``."""
        verdict, _, place = text.partition(" ")
        host, slash, path = place.partition("/")
        return cls(verdict, host, slash + path)

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _by_expression(places: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The longest rule that fits as one CASE, longest first."""
    found = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name, r.verdict)):
        here = (F.col("_host") == r.host) | F.col("_host").endswith(f".{r.host}")
        found = found.when(here & F.col("_path").startswith(r.path), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")))
    return places.withColumn("_found", found)


def _by_join(places: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same by equi joins: hosts meet rules by their suffixes, places by the beginnings of paths."""
    table = places.sparkSession.createDataFrame(
        [(r.host, r.path, r.name, r.verdict) for r in rules],
        "_rule_host string, _rule_path string, rule string, verdict string",
    )
    lengths = F.array(*[F.lit(n) for n in sorted({len(r.path) for r in rules})])
    distinct = places.select("_host", "_path").distinct()
    labels = F.split("_host", r"\.")
    from_label = lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), from_label))
    hosts = distinct.select("_host").distinct().select("_host", suffix.alias("_rule_host"))
    ruled = hosts.join(table.select("_rule_host").distinct(), "_rule_host")
    fitting = F.filter(lengths, lambda n: n <= F.length("_path"))
    begins = F.array_distinct(F.transform(fitting, lambda n: F.substring(F.col("_path"), F.lit(1), n)))
    tried = distinct.join(ruled, "_host").withColumn("_rule_path", F.explode(begins))
    best = tried.join(table, ["_rule_host", "_rule_path"]).groupBy("_host", "_path").agg(
        F.min(F.struct((-F.length("rule")).alias("_n"), "rule", "verdict")).alias("_best")
    )
    best = best.select("_host", "_path", F.struct("_best.rule", "_best.verdict").alias("_found"))
    return places.join(best, ["_host", "_path"], "left")


def judge_by_rules(places: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``places`` (``_host``, ``_path``) with ``_found``: the longest rule that fits and its verdict, or null."""
    return _by_expression(places, rules) if len(rules) <= LITERAL_RULES else _by_join(places, rules)


def host_edges(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(_from, _to, _links) for links in href attributes to another host, summed up."""
    pattern = r"""(?is)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>\\]+)"""
    links = F.explode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1)))
    found = pages.select(host_of(F.col(url)).alias("_from"), links.alias("_to"))
    found = found.withColumn("_to", F.translate("_to", UPPER, LOWER))
    found = found.where("_from != '' AND _to != '' AND _from != _to")
    return found.groupBy("_from", "_to").agg(F.count(F.lit(1)).alias("_links"))


def spread(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, iterations: int = ITERATIONS) -> DataFrame:
    """(_host, _score): personalised PageRank over weighted edges (_from, _to, _share).

    The restart mass of a host is its ``_seed``, so scores are those of PageRank divided by
    1 - ``damping``. Shares may be those of the sending host's links or, against the links, of the receiving
    host's, which gives the part that each host has in the seeds' ranks. Each step sends a host's score along its edges by share
    and adds the restart; what a host without edges holds is not passed on. Every few steps the scores are written,
    which cuts the plan. A hub is a skewed join key that Spark splits; sums have a partial step.
    """
    scores = restart = seeds.select("_host", F.col("_seed").alias("_score"))
    for i in range(iterations):
        sent = edges.join(scores, edges["_from"] == scores["_host"]).select(
            F.col("_to").alias("_host"), (damping * F.col("_score") * F.col("_share")).alias("_score")
        )
        scores = sent.union(restart).groupBy("_host").agg(F.sum("_score").alias("_score"))
        if (i + 1) % WRITE_EVERY == 0:
            scores = keep(scores, "scores")
    return scores


def host_verdicts(
    places: DataFrame, edges: DataFrame, margin: float = MARGIN, damping: float = DAMPING,
    iterations: int = ITERATIONS,
) -> DataFrame:
    """``_host``, ``trust``, ``distrust`` and ``blocked`` of every host with either.

    ``places`` holds judged pages. The seed of trust is the share of a host's pages that a rule
    allows, that of distrust the share that a rule blocks. Trust follows links and is split over the
    links of the host that gives it. Distrust goes against them, by the share that a link has of all links of
    the host that receives it: what counts is how much of a host's own linking leads to blocked hosts,
    in one step or several, not how many others link there too. A host is blocked if its distrust exceeds its
    trust by ``margin``.
    """
    share = lambda v: F.avg((F.coalesce(F.col("_found.verdict"), F.lit("")) == v).cast("double"))
    shares = share("allow").alias("_allow"), share("block").alias("_block")
    seeds = keep(places.where("_host != ''").groupBy("_host").agg(*shares), "seeds")
    edges = keep(edges, "edges")

    total = edges.groupBy("_from").agg(F.sum("_links").alias("_sum"))
    part = (F.col("_links") / F.col("_sum")).alias("_share")
    forward = keep(edges.join(total, "_from").select("_from", "_to", part), "shares")
    backward = forward.select(F.col("_to").alias("_from"), F.col("_from").alias("_to"), "_share")

    def scores(seed: str, graph: DataFrame, name: str) -> DataFrame:
        some = seeds.where(F.col(seed) > 0).select("_host", F.col(seed).alias("_seed"))
        return spread(some, graph, damping, iterations).withColumnRenamed("_score", name)

    trust = scores("_allow", forward, "trust")
    distrust = scores("_block", backward, "distrust")
    both = trust.join(distrust, "_host", "full").na.fill(0.0, ["trust", "distrust"])
    return both.withColumn("blocked", F.col("distrust") > F.col("trust") + margin)


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], url: str = "url", html: str = "html",
    columns: Sequence[str] | None = None, margin: float = MARGIN, iterations: int = ITERATIONS,
) -> DataFrame:
    """``pages`` (or some ``columns``) with ``host``, ``path``, ``rule``, ``verdict``.

    The longest rule that fits decides; a page that no rule fits gets its host's verdict from the
    link graph, and ``allow`` if the host is unknown to it. A null url and one without ``://`` have
    an empty host and path, no rule, and are allowed. Null html has no links. Repeated pages and
    links count as often as they occur. Input columns of the new names are replaced. An empty table
    gives an empty result.

    Of the hosts, only the blocked ones meet the pages again; a hot host there is a skewed key of
    the larger side.
    """
    new = ["host", "path", "rule", "verdict", "_host", "_path", "_found"]
    kept = [c for c in (columns or pages.columns) if c.lower() not in new]
    place = host_of(F.col(url)).alias("_host"), path_of(F.col(url)).alias("_path")
    places = pages.select(*kept, *place)
    judged = judge_by_rules(pages.select(*place), rules)
    known = host_verdicts(judged, host_edges(pages, url, html), margin, DAMPING, iterations)
    blocked = keep(known.where("blocked").select("_host", F.lit("block").alias("_verdict")), "blocked")
    judged = judge_by_rules(places, rules).join(blocked, "_host", "left")
    return judged.select(
        *kept,
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_found.rule").alias("rule"),
        F.coalesce("_found.verdict", "_verdict", F.lit("allow")).alias("verdict"),
    )
