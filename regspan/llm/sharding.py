"""Sharding by fixed virtual slots and a versioned map from slots to shards.

A record's id and text decide its slot, one of a fixed number of thousands. Bytes and rows are summed per
slot; the map from slots to shards is stored, one version after the other, and only ever edited: to
balance bytes, slots move from the fullest to the emptiest shard; for one shard more, slots move into the
new one alone. Records never move unless their slot does.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import keep
from .frames import without

SLOTS = 8192
# A slot that holds more than this part of a shard is shared by several shards.
FINE = 16

MAP = "slot int, shards array<int>, bytes array<long>, rows array<long>, parent int, reason string"

# One part of a slot: nearly always the only one.
Part = tuple[int, int]


@dataclass
class Version:
    """One version of the map, as plain rows: at most ``slots`` and 16 parts for every shard."""

    number: int
    shards: int
    place: dict[Part, int]
    bytes: dict[Part, int] = field(default_factory=dict)
    rows: dict[Part, int] = field(default_factory=dict)
    parent: int | None = None
    reason: str = "first"

    def parts(self) -> dict[int, list[Part]]:
        out: dict[int, list[Part]] = defaultdict(list)
        for part in sorted(self.place):
            out[part[0]].append(part)
        return out

    def load(self) -> list[int]:
        out = [0] * self.shards
        for part, shard in self.place.items():
            out[shard] += self.bytes.get(part, 0)
        return out


def publish(spark: SparkSession, path: str, version: Version) -> None:
    """Write a version beside the earlier ones; a number that is taken is an error."""
    rows = [
        (
            slot,
            [version.place[p] for p in parts],
            [version.bytes.get(p, 0) for p in parts],
            [version.rows.get(p, 0) for p in parts],
            version.parent,
            version.reason,
        )
        for slot, parts in version.parts().items()
    ]
    target = f"{path}/shards={version.shards}/version={version.number}"
    spark.createDataFrame(rows, MAP).coalesce(1).write.mode("errorifexists").parquet(target)


def read_version(spark: SparkSession, path: str, shards: int, number: int) -> Version:
    rows = spark.read.schema(MAP).parquet(f"{path}/shards={shards}/version={number}").collect()
    out = Version(number, shards, {}, parent=rows[0].parent, reason=rows[0].reason)
    for r in rows:
        for k, (shard, size, count) in enumerate(zip(r.shards, r.bytes, r.rows)):
            out.place[r.slot, k], out.bytes[r.slot, k], out.rows[r.slot, k] = shard, size, count
    return out


def first_version(shards: int, parts: dict[int, int], slots: int = SLOTS) -> Version:
    """All slots dealt out in turn; slot s has ``parts.get(s, 1)`` parts."""
    place = {(s, k): (s + k) % shards for s in range(slots) for k in range(parts.get(s, 1))}
    return Version(0, shards, place)


def _move(version: Version, place: dict[Part, int], number: int, reason: str, shards: int) -> Version:
    return Version(number, shards, place, version.bytes, version.rows, version.number, reason)


def balanced(version: Version) -> Version:
    """The next version: slots move from the fullest to the emptiest shard while that evens them out.

    Each move takes the slot nearest to half of the difference, so few slots move. In the end no slot of
    the fullest shard is smaller than its distance to the emptiest one.
    """
    place, load = dict(version.place), version.load()
    held: list[list[tuple[int, Part]]] = [[] for _ in load]
    for part, shard in place.items():
        if version.bytes.get(part, 0):
            held[shard].append((version.bytes[part], part))
    for parts in held:
        parts.sort()
    while True:
        full = max(range(len(load)), key=lambda s: (load[s], -s))
        empty = min(range(len(load)), key=lambda s: (load[s], s))
        gap = load[full] - load[empty]
        parts = held[full]
        i = bisect_left(parts, (gap / 2,))
        near = [k for k in (i - 1, i) if 0 <= k < len(parts) and parts[k][0] < gap]
        if not near:
            return _move(version, place, version.number + 1, "balance", version.shards)
        size, part = parts.pop(min(near, key=lambda k: abs(2 * parts[k][0] - gap)))
        insort(held[empty], (size, part))
        load[full] -= size
        load[empty] += size
        place[part] = empty


def grown(version: Version) -> Version:
    """The first version for one shard more: slots move into it until it has its part, all others stay."""
    shards = version.shards + 1
    place, load = dict(version.place), version.load() + [0]
    goal = sum(load) / shards
    held: list[list[tuple[int, Part]]] = [[] for _ in load]
    for part, shard in sorted(place.items()):
        held[shard].append((version.bytes.get(part, 0), part))
    for parts in held:
        parts.sort()
    while True:
        full = max(range(shards - 1), key=lambda s: (load[s], -s))
        room = min(goal - load[-1], load[full] - load[-1])
        i = bisect_left(held[full], (room,)) - 1
        if i < 0 or not held[full][i][0]:
            return _move(version, place, 0, "grow", shards)
        size, part = held[full].pop(i)
        load[full] -= size
        load[-1] += size
        place[part] = shards - 1


def slot_of(id: str, checksum: str, size: str, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(id, checksum, size), F.lit(slots)).cast("int")


def part_of(row: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(row), parts).cast("int")


def _sums(rows: DataFrame, *by: str) -> list:
    return rows.groupBy(*by).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()


def plan(spark: SparkSession, rows: DataFrame, path: str, shards: int, slots: int = SLOTS, fine: int = FINE) -> Version:
    """Sum bytes by slot, deal the slots out (version 0), balance them (version 1), publish both.

    ``rows`` has ``_slot``, ``_row`` and ``size``. The driver sees one row per slot, and for slots
    that hold more than 1 / ``fine`` of a shard (rows repeated very often, very long texts) one row per part.
    """
    sums = _sums(rows, "_slot")
    most = max(1, sum(r.bytes for r in sums) // (shards * fine))
    parts = {r._slot: min(r.n, -(-r.bytes // most)) for r in sums if r.bytes > most and r.n > 1}
    version = first_version(shards, parts, slots)
    for r in sums:
        if r._slot not in parts:
            version.bytes[r._slot, 0], version.rows[r._slot, 0] = r.bytes, r.n
    if parts:
        known = spark.createDataFrame(sorted(parts.items()), "_slot int, _parts int")
        hot = rows.join(F.broadcast(known), "_slot").withColumn("_part", part_of("_row", F.col("_parts")))
        for r in _sums(hot, "_slot", "_part"):
            version.bytes[r._slot, r._part], version.rows[r._slot, r._part] = r.bytes, r.n
    publish(spark, path, version)
    version = balanced(version)
    publish(spark, path, version)
    return version


def assign(rows: DataFrame, version: Version) -> DataFrame:
    """``rows`` with ``shard`` and ``position``: the place within the shard, gapless from 0.

    Rows are counted within parts of slots, the parts of a shard one behind the other; no task sees
    more than a part. The map is broadcast: its size is set by the number of slots and shards.
    """
    spark = rows.sparkSession
    at, table = [0] * version.shards, []
    for slot, parts in version.parts().items():
        starts = []
        for p in parts:
            starts.append(at[version.place[p]])
            at[version.place[p]] += version.rows.get(p, 0)
        table.append((slot, [version.place[p] for p in parts], starts))
    known = spark.createDataFrame(table, "_slot int, _shards array<int>, _starts array<long>")
    placed = rows.join(F.broadcast(known), "_slot").withColumn("_part", part_of("_row", F.size("_shards")))
    within = F.expr("row_number() OVER (PARTITION BY _slot, _part ORDER BY _id, text_crc32, size, _row)")
    return (
        placed.withColumn("_within", within)
        .withColumn("shard", F.expr("_shards[_part]"))
        .withColumn("position", F.expr("_starts[_part] + _within - 1"))
        .drop("_shards", "_starts", "_within", "_part", "_slot", "_row", "_id")
    )


def shard_documents(
    docs: DataFrame, path: str, shards: int = 8, id: str = "doc_id", text: str = "text",
    columns: list[str] | None = None, slots: int = SLOTS,
) -> DataFrame:
    """``docs`` (or some ``columns``) with ``size``, ``text_crc32``, ``shard`` and ``position``.

    ``size`` is the text's UTF-8 bytes plus 1, and the sum over a shard is what is balanced: shards
    differ by less than the smallest slot of the fullest one, unless single texts are larger than that.
    ``path`` receives the versions of the map. Equal texts of different ids lie in different slots. Rows equal
    in id and text share a slot; if it holds more than a sixteenth of a shard, they are dealt to several
    shards by a row number that is fixed by being written.

    A null text has no bytes and the checksum 0; a null id is an id like any other; repeated rows are
    placed each; an empty table leaves a map without bytes and gives an empty result. Input columns of
    the new names, and those beginning with an underscore that are used within, are replaced.
    """
    own = ["size", "text_crc32", "shard", "position", "_id", "_slot", "_row", "_part", "_parts", "_shards", "_starts", "_within"]
    kept = [c for c in (columns or docs.columns) if c.lower() not in own]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col(f"`{id}`").alias("_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumn("_slot", slot_of("_id", "text_crc32", "size", slots))
    rows = keep(rows.withColumn("_row", F.monotonically_increasing_id()), "slots")
    return assign(rows, plan(docs.sparkSession, rows, path, shards, slots))


def write_shards(assigned: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Write the shards as ``shard=…`` folders of files that hold consecutive positions, in order."""
    file = F.floor(F.col("position") / rows_per_file)
    dealt = without(assigned, ["_file"]).withColumn("_file", file).repartition("shard", "_file")
    ordered = dealt.sortWithinPartitions("shard", "position").drop("_file")
    ordered.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
