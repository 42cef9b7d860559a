"""Virtual slots, the versions of their map, and places within shards."""

import random
import zlib
from collections import defaultdict

import pytest
import xxhash

from regspan.llm.queries import QUERIES
from regspan.llm.sharding import (
    Version, balanced, first_version, grown, publish, read_version, shard_documents, write_shards,
)


def loads(version):
    return version.load()


def made(shards, sizes, slots=64):
    version = first_version(shards, {}, slots)
    version.bytes = {(s, 0): b for s, b in enumerate(sizes)}
    return version


def test_balancing_edits_the_map():
    rng = random.Random(1)
    for _ in range(20):
        sizes = [rng.choice([0, 1, 10, rng.randrange(1, 2000)]) for _ in range(64)]
        before = made(rng.choice([1, 3, 8]), sizes)
        after = balanced(before)
        assert (after.number, after.parent, sum(loads(after))) == (1, 0, sum(sizes))
        spread = max(loads(after)) - min(loads(after))
        assert spread <= max(loads(before)) - min(loads(before))
        full = loads(after).index(max(loads(after)))
        own = [after.bytes[p] for p, s in after.place.items() if s == full and after.bytes[p]]
        assert spread <= min(own, default=0) or spread == 0
        again = balanced(after)
        assert again.place == after.place
        moved = sum(after.place[p] != before.place[p] for p in after.place)
        assert moved < 64


def test_one_more_shard_takes_slots_only_into_itself():
    rng = random.Random(2)
    version = balanced(made(8, [rng.randrange(500, 1500) for _ in range(512)], 512))
    more = grown(version)
    assert more.shards == 9 and all(more.place[p] in (8, s) for p, s in version.place.items())
    assert abs(loads(more)[8] - sum(loads(more)) / 9) < 1500
    assert max(loads(more)) - min(loads(more)) < 3000


def test_versions_are_kept(spark, tmp_path):
    path = f"{tmp_path}/map"
    first = made(4, range(64))
    publish(spark, path, first)
    second = balanced(first)
    publish(spark, path, second)
    with pytest.raises(Exception, match="(?i)exist"):
        publish(spark, path, second)
    assert read_version(spark, path, 4, 0).place == first.place
    stored = read_version(spark, path, 4, 1)
    assert (stored.place, stored.bytes, stored.parent, stored.reason) == (second.place, second.bytes, 0, "balance")


def slot(id, crc, size, slots):
    h = 42
    for v in (id, crc, size):
        if v is not None:
            h = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), seed=h)
    return (h - (1 << 64) if h >> 63 else h) % slots


def test_query_by_brute_force(spark, tmp_path):
    rng = random.Random(3)
    texts = ["é" * rng.randrange(1, 400) for _ in range(600)] + ["same text"] * 300 + [None, "", "x" * 20_000]
    rows = list(enumerate(texts)) + [(None, "a"), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_shards"](spark, str(tmp_path)).collect()
    size = lambda t: len((t or "").encode()) + 1
    want = sorted((str(i), size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    places, bytes_ = defaultdict(list), defaultdict(int)
    for r in got:
        assert (r.law, r.grown_shard) == ("bytes", None)
        places[r.shard].append(r.slot)
        bytes_[r.shard] += r.size
    assert set(places) == set(range(8))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    least = sorted(bytes_.values())
    assert least[-1] - least[0] <= 30 or (least[-1] >= 20_001 and least[-2] - least[0] <= 30)
    again = QUERIES["op12_shards"](spark, str(tmp_path)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_rows_follow_the_stored_map(spark, tmp_path):
    rows = [(i, f"text {i} " * (i % 50), "kept", 1) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, shard int").repartition(4)
    placed = shard_documents(docs, f"{tmp_path}/map", shards=5, slots=1024)
    assert placed.columns == ["doc_id", "text", "lang", "size", "text_crc32", "shard", "position"]
    version = read_version(spark, f"{tmp_path}/map", 5, 1)
    got = placed.collect()
    for r in got:
        s = slot(r.doc_id, r.text_crc32, r.size, 1024)
        assert version.place[s, 0] == r.shard
    total = defaultdict(int)
    for r in got:
        total[r.shard] += r.size
    assert [total[s] for s in range(5)] == version.load()
    write_shards(placed, f"{tmp_path}/out", rows_per_file=150)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(str, back.select(placed.columns).collect())) == sorted(map(str, got))
    assert len(back.inputFiles()) >= 2000 // 150


def test_a_third_of_all_rows_equal(spark, tmp_path):
    rows = [(7, "hot row")] * 4000 + [(i, f"cold {i}") for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    placed = shard_documents(docs, f"{tmp_path}/map", shards=8, columns=["doc_id"]).collect()
    total, hot = defaultdict(int), defaultdict(int)
    for r in placed:
        total[r.shard] += r.size
        hot[r.shard] += r.doc_id == 7 and r.size == 8
    assert max(total.values()) - min(total.values()) <= 40 and min(hot.values()) > 0
    assert sorted((r.shard, r.position) for r in placed) == [
        (s, i) for s in range(8) for i in range(sum(r.shard == s for r in placed))
    ]
    version = read_version(spark, f"{tmp_path}/map", 8, 1)
    assert isinstance(version, Version) and max(len(p) for p in version.parts().values()) > 8


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert shard_documents(docs, f"{tmp_path}/map").collect() == []
    assert set(read_version(spark, f"{tmp_path}/map", 8, 1).load()) == {0}
