"""One query per operator on the given tables, and its SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import own_folder
from .chat import format_chats
from .decontaminate import find_passages
from .frames import settle, words_of
from .html import extract_text
from .minhash import near_duplicates
from .mixing import plan_mix
from .quality import classify
from .repair import repair
from .rules import MEASURES, cascade, with_measures
from .runs import find_runs
from .sharding import shard_documents
from .tokens import count_tokens
from .urls import Rule, judge_urls
from .warc import captures, read_records, write_archives

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def settled(spark: SparkSession, sf: str) -> DataFrame:
            settle(spark)
            return fn(spark, sf)

        QUERIES[fn.__name__] = settled
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, coalesce(source, '') AS src, source IS NULL AS no_src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5(concat('mix-1:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS h
  FROM documents),
sources AS (
  SELECT src, no_src, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + CAST((row_number() OVER (ORDER BY no_src, src) - 1) % 3 AS INTEGER)] AS w
  FROM sized GROUP BY src, no_src),
filled AS (
  SELECT *, 3 * source_size AS cap,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
           ORDER BY 3 * source_size / w, no_src, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY 3 * source_size / w, no_src, src
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight
  FROM sources),
level AS (
  SELECT rest AS l_rest, weight AS l_weight FROM filled WHERE rest * w < cap * weight
  ORDER BY cap / w, no_src, src LIMIT 1),
goal AS (
  SELECT src, no_src, source_size,
         CASE WHEN rest * w >= cap * weight THEN CAST(cap AS DOUBLE)
              ELSE CAST(l_rest * w AS DOUBLE) / CAST(l_weight AS DOUBLE) END AS target,
         CAST(CAST('0x' || substr(md5(concat('mix-1/', CASE WHEN no_src THEN '-' ELSE concat('+', src) END)), 1, 5)
              AS BIGINT) AS DOUBLE) / 1048576.0 AS u
  FROM filled LEFT JOIN level ON true),
ranked AS (
  SELECT s.*, g.source_size, g.target, g.u,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
         row_number() OVER (PARTITION BY s.src, s.no_src ORDER BY
           length(CAST(size AS VARCHAR)) * 100 + CAST(substr(CAST(size AS VARCHAR), 1, 2) AS INTEGER), h, size) AS i
  FROM sized s JOIN goal g ON s.src = g.src AND s.no_src = g.no_src),
taken AS (
  SELECT *, CAST(floor(i * rate + u) - floor((i - 1) * rate + u) AS BIGINT) AS copies FROM ranked)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, copies * size AS taken, copies FROM taken
"""


@query(MIX_SQL)
def op1_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Words that a mix by source weights takes of each document."""
    return plan_mix(table(spark, sf, "documents"), columns=["doc_id"])


CHAT_SQL = r"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         role IS NULL AS no_role, text IS NULL AS no_text
  FROM conversations),
numbered AS (
  SELECT *, CASE WHEN turn IS NULL THEN -1
                 ELSE (dense_rank() OVER (PARTITION BY conv_id, turn IS NULL ORDER BY turn) - 1) // 1024 END AS part,
         concat('<|im_start|>', replace(replace(role, '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>'),
                   chr(10), replace(replace(text, '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>'),
                   '<|im_end|>', chr(10)) AS piece,
         concat(turn, ' ', no_role, ' ', no_text, ' ', length(role), ' ', length(text), ' ', role, text, ';') AS exact
  FROM turns),
shown AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id, part ORDER BY turn, NOT no_role, role, NOT no_text, text) - 1) // 4096 AS cut
  FROM numbered),
prefixes AS (
  SELECT conv_id, turn, string_agg(exact, '' ORDER BY exact) AS own, count(*) AS c FROM shown GROUP BY conv_id, turn),
sums AS (
  SELECT *, string_agg(own, '|') OVER w AS prefix, sum(c) OVER (PARTITION BY conv_id) AS n, sum(c) OVER w AS i
  FROM prefixes WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST)),
whole AS (SELECT prefix, n, min(conv_id) AS conv_id FROM sums WHERE i = n GROUP BY prefix, n),
kept AS (
  SELECT conv_id FROM whole w
  WHERE NOT EXISTS (SELECT 1 FROM sums p WHERE p.prefix = w.prefix AND p.i < p.n))
SELECT s.conv_id, min(turn) AS first_turn, count(*) AS n_turns,
       string_agg(piece, '' ORDER BY turn, NOT no_role, role, NOT no_text, text) AS text
FROM shown s JOIN kept k ON s.conv_id IS NOT DISTINCT FROM k.conv_id GROUP BY s.conv_id, part, cut
"""


@query(CHAT_SQL)
def op2_chat(spark: SparkSession, sf: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return format_chats(table(spark, sf, "conversations"))


PASSAGES_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, unnest(list_transform(
    range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS win
  FROM item_words WHERE len(w) > 0),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
places AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (
  SELECT a.r, a.i, a.n, b.item_id
  FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM places) a
  JOIN windows b ON a.win = b.win AND a.n = b.n),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (
  SELECT r, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n, 0) AS BIGINT) AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered c USING (r) LEFT JOIN found f USING (r)
"""


@query(PASSAGES_SQL)
def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Words of each document inside 13-word windows of the benchmark, and the items they are from."""
    found = find_passages(table(spark, sf, "documents"), table(spark, sf, "benchmark"), columns=["doc_id"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), "contaminated",
    )


NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON c.a = x.doc_id JOIN sizes y ON c.b = y.doc_id
  WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id,
       d.doc_id = c.component_id AS kept
FROM documents d JOIN component c ON d.doc_id = c.doc_id LEFT JOIN sizes s ON d.doc_id = s.doc_id
"""


@query(NEAR_SQL)
def op4_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a similarity of 0.8 or more."""
    return near_duplicates(table(spark, sf, "documents"), width=4)


RULES_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1)
  GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
base AS (
  SELECT doc_id, t, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper
  FROM words LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 25 * n_words OR word_chars < 2 * n_words
            OR word_chars > 25 * n_words OR 2 * n_dup_lines > n_words OR 100 * n_upper > 30 * word_chars) AS kept
FROM judged
"""


@query(RULES_SQL)
def op8_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Quality measures of each document and the verdict of the rule cascade."""
    shown = [n for n in MEASURES if n != "n_upper"]
    measured = with_measures(table(spark, sf, "documents").select("doc_id", "text"), names=shown)
    judged = cascade(measured, known={n: n for n in shown})
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), F.col("failed_rule").isNull().alias("kept"),
    )


@query()
def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of each document, learned from labels outside the held-out fifth."""
    return classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


TOKEN_LIMIT = 1024


@query()
def op7_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of each whole document under a byte-level BPE of 50,257 ids."""
    import public_tokenizers

    docs = table(spark, sf, "documents")
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), columns=["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query()
def op9_html(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of each page."""
    return extract_text(table(spark, sf, "pages"), columns=["page_id", "url"])


WARC_SQL = r"""
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
bits AS (
  SELECT *, list_transform(range(0, 8), lambda i: CAST('0x' || substr(h, CAST(i * 5 + 1 AS INTEGER), 5) AS BIGINT)) AS fives
  FROM sized),
named AS (
  SELECT page_id, n, array_to_string(list_transform(fives, lambda v: concat(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 15) & 31 AS INTEGER) + 1, 1),
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 10) & 31 AS INTEGER) + 1, 1),
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 5) & 31 AS INTEGER) + 1, 1),
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v & 31 AS INTEGER) + 1, 1))), '') AS digest
  FROM bits),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM named)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to,
       concat('urn:capture:', page_id, ':', digest, ':request') AS request_id
FROM firsts
"""


@query(WARC_SQL)
def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Captures of all pages, written to archives and read back."""
    path = f"{own_folder(spark)}/archives-{uuid.uuid4().hex}"
    write_archives(table(spark, sf, "pages"), path)
    found = captures(read_records(spark, path, payloads=False))
    stated = F.col("metadata")[0]["fields"]
    return found.select(
        stated["captureid"].cast("long").alias("page_id"),
        # A revisit has no payload of its own; of all others the archive's own bytes are counted.
        F.when(F.col("response.type") == "revisit", stated["payloadlength"].cast("long"))
        .otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.coalesce("response.payload_digest", "response.digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.regexp_extract("response.refers_to", "^urn:capture:([0-9-]+):", 1).cast("long").alias("refers_to"),
        F.col("request.record_id").alias("request_id"),
    )


URL_RULES = [
    Rule.parse(r) for r in ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")
]


def _urls_sql() -> str:
    """The same steps, the iterations of either rank as one view each."""

    def rank(name: str, seed: str, start: str, stop: str) -> str:
        views = [
            f"{name}_shares AS MATERIALIZED (SELECT {start} AS a, {stop} AS b, links / sum(links) OVER (PARTITION BY {start}) AS share FROM edges)",
            f"{name}_0 AS MATERIALIZED (SELECT host, {seed} AS score FROM seeds WHERE {seed} > 0)",
        ]
        for i in range(1, 21):
            views.append(f"""{name}_{i} AS MATERIALIZED (SELECT host, sum(score) AS score FROM (
  SELECT s.b AS host, 0.85 * r.score * s.share AS score FROM {name}_shares s JOIN {name}_{i - 1} r ON s.a = r.host
  UNION ALL SELECT host, {seed} AS score FROM seeds WHERE {seed} > 0) GROUP BY host)""")
        return ",\n".join(views)

    cases = " ".join(
        f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN '{r.verdict} {r.name}'"
        for r in sorted(URL_RULES, key=lambda r: (-len(r.name), r.name))
    )
    return f"""
WITH urls AS (
  SELECT page_id, html,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
judged AS (SELECT *, CASE {cases} END AS found FROM urls),
seeds AS MATERIALIZED (
  SELECT host, avg(CAST(coalesce(found LIKE 'allow %', false) AS INTEGER)) AS allowed,
         avg(CAST(coalesce(found LIKE 'block %', false) AS INTEGER)) AS blocked
  FROM judged WHERE host <> '' GROUP BY host),
links AS (
  SELECT host AS src, lower(unnest(regexp_extract_all(
    html, '(?is)\\bhref\\s*=\\s*["'']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\\s<>\\\\]+)', 1))) AS dst
  FROM urls),
edges AS MATERIALIZED (
  SELECT src, dst, count(*) AS links FROM links WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
{rank("trust", "allowed", "src", "dst")},
{rank("distrust", "blocked", "dst", "src")}
SELECT page_id, j.host, path, substr(found, 7) AS rule,
       CASE WHEN found IS NOT NULL THEN substr(found, 1, 5)
            WHEN coalesce(d.score, 0) > coalesce(t.score, 0) + 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM judged j LEFT JOIN trust_20 t ON j.host = t.host LEFT JOIN distrust_20 d ON j.host = d.host
"""


@query(_urls_sql())
def op6_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict on each page's url by rules, else by its host's place in the link graph."""
    return judge_urls(table(spark, sf, "pages"), URL_RULES, columns=["page_id"])


# crc32 of a column ``k`` of ASCII strings, eight divisions per byte.
CRC_SQL = """CAST(xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
      lambda v, step: xor(v >> 1, (v & 1) * 3988292384)))) AS BIGINT)"""

RUNS_SQL = rf"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, CAST(doc_id AS VARCHAR) AS k,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
keyed AS (
  SELECT *, len(w) AS n, {CRC_SQL} AS h FROM split),
cut AS (
  SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM keyed),
damaged AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
      list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
    ELSE w END AS w
  FROM cut),
-- A run holds at least 6 words in a row that recur one period later: equal places of 6 words.
sixes AS (
  SELECT r, i, md5(array_to_string(w[i + 1:i + 6], ' ')) AS six
  FROM (SELECT r, w, unnest(range(0, len(w) - 5)) AS i FROM damaged WHERE len(w) >= 12)),
pairs AS (
  SELECT x.r, x.i, y.i - x.i AS p FROM sixes x JOIN sixes y ON x.r = y.r AND x.six = y.six AND x.i < y.i),
stretches AS (
  SELECT r, p, min(i) AS start, count(*) + 5 + p AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM pairs)
  GROUP BY r, p, island HAVING count(*) + 5 + p >= greatest(12, 2 * p)),
runs AS (SELECT r, start, length, min(p) AS period FROM stretches GROUP BY r, start, length),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS shown
  FROM runs GROUP BY r),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length DESC, start, period) = 1),
gone AS (
  SELECT r, list(DISTINCT i) AS dropped
  FROM (SELECT r, unnest(range(start + period, start + length)) AS i FROM runs) GROUP BY r),
words AS (SELECT r, unnest(w) AS word, unnest(range(0, n)) AS i FROM damaged WHERE n > 0),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed
  FROM words LEFT JOIN (SELECT r, unnest(dropped) AS i, true AS gone FROM gone) USING (r, i)
  WHERE gone IS NULL GROUP BY r)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start,
       CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
       CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(shown, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM damaged LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, the tail of every tenth text replaced by repetitions of its beginning.

    Which texts, from which word on and with which period follows from the id alone; a null id has none.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    told = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), F.when(h % 10 == 0, words_of(F.col("text"))).alias("w"))
    told = told.withColumn("n", F.size("w")).withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END"))
    repeated = F.expr(
        "array_join(transform(w, (x, i) -> CASE WHEN i < a THEN x"
        " ELSE w[CAST(a + (i - a) % (1 + (n - a) DIV (3 + g % 8)) AS INT)] END), ' ')"
    )
    return told.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


@query(RUNS_SQL)
def op11_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic runs of words in each document, and the text without repetitions."""
    found = find_runs(with_repeats(table(spark, sf, "documents")), columns=["doc_id"])
    best = F.expr(
        "CASE WHEN size(runs) > 0 THEN"
        " array_max(transform(runs, r -> struct(r.length AS length, -r.start AS before, -r.period AS period))) END"
    )
    told = found.withColumn("best", best)
    shown = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return told.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.before")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length DIV -best.period").alias("exponent_milli"),
        F.sha2(shown, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op12_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Documents dealt to eight shards of nearly equal bytes; ``slot`` is the place within the shard."""
    path = f"{own_folder(spark)}/shard-map-{uuid.uuid4().hex}"
    placed = shard_documents(table(spark, sf, "documents"), path, shards=8, columns=["doc_id"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("position").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def _repair_sql() -> str:
    """Row by row: a state of the pattern holds its least (cost, edits) and the lines that they give."""

    def step(state: str, cost: int, edits: str, lines: str) -> str:
        return (f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edits}',"
                f" 't': list_concat({state}.t, {lines})}} END")

    def least(*ways: str) -> str:
        return f"list_min(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))"

    def inserted(state: str, *roles: str) -> str:
        lines = "[" + ", ".join(f"'{r}:'" for r in roles) + "]"
        return step(state, 3 * len(roles), "I" * len(roles), lines)

    def some(condition: str, way: str) -> str:
        return f"CASE WHEN {condition} THEN {way} END"

    def kept(state: str, initial: str) -> str:
        ways = [f"{{'c': {state}.c + extra, 'a': {state}.a || 'K', 't': list_append({state}.t, role || ':' || text)}}"]
        return some(f"{state} IS NOT NULL AND fault NOT IN ('b', 'd') AND role[1] = '{initial}'", ways[0])

    def rerole(state: str, name: str) -> str:
        way = f"{{'c': {state}.c + 3 + extra, 'a': {state}.a || 'R', 't': list_append({state}.t, '{name}:' || text)}}"
        return some(f"{state} IS NOT NULL AND fault NOT IN ('b', 'd')", way)

    gone = [step(f"q{k}", 4, "D", "[]") for k in range(4)]
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS k
  FROM conversations),
drawn AS (SELECT *, {CRC_SQL} % 20 AS d FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(0, CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM drawn)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 't' ELSE 'k' END AS fault,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
walk(conv_id, i, s0, s1, s2, s3) AS (
  SELECT conv_id, CAST(0 AS BIGINT), {{'c': 0, 'a': '', 't': []::VARCHAR[]}},
         NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR[]), NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR[]),
         NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR[])
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {gone[0]}, {least(gone[1], kept('q0', 's'))},
         {least(gone[2], *[kept(q, 'u') for q in ('q0', 'q1', 'q3')], *[rerole(q, 'user') for q in ('q0', 'q1', 'q3')])},
         {least(gone[3], kept('q2', 'a'), rerole('q2', 'assistant'))}
  FROM (
    SELECT w.conv_id, j.i, j.role, j.text, j.fault, CASE WHEN j.fault = 't' THEN 3 ELSE 0 END AS extra,
           s0 AS q0, s1 AS q1,
           {least('s2', *[inserted(s, 'user') for s in ('s0', 's1', 's3')])} AS q2,
           {least('s3', inserted('s2', 'assistant'), *[inserted(s, 'user', 'assistant') for s in ('s0', 's1')])} AS q3
    FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1)),
ends AS (
  SELECT conv_id, {least('s0', 's3', inserted('s2', 'assistant'), inserted('s1', 'user', 'assistant'))} AS e
  FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)
SELECT ends.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(e.c AS BIGINT) AS cost, e.a AS audit,
       sha256(array_to_string(e.t, chr(10))) AS repaired_sha256
FROM ends LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ends.conv_id
"""


def with_damage(turns: DataFrame) -> DataFrame:
    """Conversations of which a fifth of the turns is dropped, emptied, cut short, repeated or given to the user."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    told = turns.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("d"),
    )
    copies = told.where("d != 0").withColumn("copy", F.explode(F.expr("CASE WHEN d = 3 THEN array(0, 1) ELSE array(0) END")))
    return copies.select(
        "conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
    )


@query(_repair_sql())
def op13_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Faults of each damaged conversation, and the cheapest edits that mend its structure."""
    turns = table(spark, sf, "conversations")
    found = repair(with_damage(turns))
    ids = turns.select("conv_id").distinct()
    lines, told = found.digests(ids), found.summary().withColumnRenamed("conv_id", "_id")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return lines.join(told, F.col("conv_id").eqNullSafe(F.col("_id")), "left").select(
        "conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), "repaired_sha256",
    )
