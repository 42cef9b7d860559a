"""Near-duplicate detection with circulant MinHash signatures and exact confirmation.

Documents are sets of shingles (runs of ``width`` words); two are linked if their Jaccard
similarity reaches ``percent`` / 100. The result is the connected components of all links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import keep
from .frames import small_batches
from .words import NOT_SPACE, mix, word_hashes

# Shingle positions run over [0, 2**22). Positions shared by two shingles only add candidates.
POSITION_BITS = 22
SEED = 20_240_511
# 64 bands of 8 coordinates: a pair of similarity 0.8 shares no band with probability 8e-6.
BANDS, ROWS = 64, 8
# The least shingle hashes kept of a set, for classes that need comparing beyond their buckets' hubs:
# all of a set of up to so many shingles.
LEAST = 512
# A pair is compared in full unless its estimate is so many standard deviations below the bound;
# a link is then missed once in 300,000, and only where it just reaches the bound.
DEVIATIONS = 4.5
# Different choices of a bucket's hub; see ``star_pairs``.
HUBS = 4

_tables: dict[int, np.ndarray] = {}


def _windows(width: int) -> np.ndarray:
    """Row p holds the second permutation at positions p, p + 1, … p + width - 1, around the circle."""
    if width not in _tables:
        order = np.random.default_rng(SEED).permutation(1 << POSITION_BITS).astype(np.uint32)
        around = np.concatenate([order, order[:width]])
        _tables[width] = np.lib.stride_tricks.sliding_window_view(around, width)
    return _tables[width]


def positions(shingles: np.ndarray) -> np.ndarray:
    """The first permutation: a bijection of the circle, applied to hashed shingles."""
    mask = np.uint64((1 << POSITION_BITS) - 1)
    x = shingles >> np.uint64(64 - POSITION_BITS)
    x = (x * np.uint64(0x2C1B3C6D)) & mask
    x = ((x ^ (x >> np.uint64(11))) * np.uint64(0x297A2D39)) & mask
    return (x ^ (x >> np.uint64(12))).astype(np.int64)


def signature(shingles: np.ndarray, width: int) -> np.ndarray:
    """Coordinate k is the least value of the second permutation, shifted by k, over the set."""
    table, at = _windows(width), positions(shingles)
    out = np.full(width, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(at), 128):
        np.minimum(out, table[at[i : i + 128]].min(axis=0), out=out)
    return out


_ODD = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of the whole sequence if it is shorter."""
    n = len(words)
    if n < width:
        return mix((words * _ODD[:n]).sum(keepdims=True) + _ODD[width + n : width + n + 1]) if n else words
    total = words[: n - width + 1] * _ODD[0]
    for j in range(1, width):
        total = total + words[j : n - width + 1 + j] * _ODD[j]
    return mix(total)


def sketch(shingles: np.ndarray, width: int) -> bytes:
    """The lowest byte of each coordinate; unequal coordinates agree on it once in 256."""
    return signature(shingles, width).astype(np.uint8).tobytes()


def _sign(batches: Iterator[pa.RecordBatch], width: int, coordinates: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, prints, sketches = [], [], []
        for _, n, _, _, hashes, first in word_hashes(batch.column("_text"), NOT_SPACE):
            for k in range(n):
                shingles = np.unique(shingle_hashes(hashes[first[k] : first[k + 1]], width))
                sizes.append(len(shingles))
                prints.append(hashlib.sha256(shingles.tobytes()).digest() if len(shingles) else None)
                sketches.append(sketch(shingles, coordinates) if len(shingles) else None)
        columns = [c for name, c in zip(batch.schema.names, batch.columns) if name != "_text"]
        names = [name for name in batch.schema.names if name != "_text"]
        new = [pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(sketches, pa.binary())]
        yield pa.RecordBatch.from_arrays([*columns, *new], [*names, "_size", "_print", "_sketch"])


def signatures(docs: DataFrame, id: str, text: str, width: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``_id``, text hash, set size, set fingerprint, sketch and a row number.

    Null and wordless texts have size 0 and no fingerprint.
    """
    rows_in = docs.select(F.col(id).alias("_id"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    schema = f"_id {docs.schema[id].dataType.simpleString()}, _hash long, _size long, _print binary, _sketch binary"
    signed = rows_in.mapInArrow(lambda it: _sign(it, width, bands * rows), schema)
    # Row numbers are fixed by being written.
    with small_batches(docs.sparkSession):
        return keep(signed.withColumn("_row", F.monotonically_increasing_id()), "signatures")


def bucket_entries(reps: DataFrame, bands: int, rows: int) -> DataFrame:
    """(_key, _band, _node) for every band of every class; equal keys share a band."""
    keys = F.expr(
        f"transform(sequence(0, {bands - 1}), b -> struct("
        f"xxhash64(b, substring(_sketch, 1 + {rows} * b, {rows})) AS _key, b AS _band))"
    )
    return reps.select(F.explode(keys).alias("_e"), "_node").select("_e._key", "_e._band", "_node")


def shared_buckets(reps: DataFrame, bands: int, rows: int) -> DataFrame:
    """The entries of buckets with two classes or more, each with its bucket's hub.

    The hub is the class that comes first in one of ``HUBS`` random orders. The same class is
    then the hub of most buckets of a family of copies, which keeps the distinct pairs few.
    """
    entries = bucket_entries(reps, bands, rows)
    order = F.struct(F.xxhash64("_node", F.col("_band") % HUBS), F.col("_node").alias("_node"))
    hubs = entries.groupBy("_key").agg(F.min(order)["_node"].alias("_hub"), F.count(F.lit(1)).alias("_n"))
    shared = entries.join(hubs.where("_n > 1").drop("_n"), "_key")
    return keep(shared.select("_key", "_band", "_node", "_hub"), "buckets")


def _verify(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    last, left = None, set()
    for batch in batches:
        a, b = batch.column("_a").to_pylist(), batch.column("_b").to_pylist()
        texts = batch.column("_text_a"), batch.column("_text_b")
        good = []
        for i in range(len(a)):
            if a[i] != last:
                last, left = a[i], shingle_set(texts[0][i].as_py(), width)
            right = shingle_set(texts[1][i].as_py(), width)
            common = len(left & right)
            good.append(100 * common >= percent * (len(left) + len(right) - common))
        yield batch.select(["_a", "_b"]).filter(pa.array(good))


def shingle_set(text: str | None, width: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``."""
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[j:] for j in range(width))))


def texts_of(nodes: DataFrame, reps: DataFrame, docs: DataFrame, id: str, text: str) -> DataFrame:
    """``_node`` and ``_text`` of some classes, written once."""
    named = reps.join(nodes, "_node").select("_node", "_id", "_hash")
    found = docs.select(F.col(id).alias("_id"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    same = F.col("n._id").eqNullSafe(F.col("t._id")) & (F.col("n._hash") == F.col("t._hash"))
    texts = found.alias("t").join(named.alias("n"), same).select("n._node", "t._text")
    return keep(texts.dropDuplicates(["_node"]), "texts")


def confirm(
    pairs: DataFrame, reps: DataFrame, docs: DataFrame, id: str, text: str, width: int, percent: int
) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity, written once.

    Texts are fetched once per class, only for classes in a pair. A class in very many pairs
    is a skewed join key, which Spark splits.
    """
    wanted = pairs.select(F.explode(F.array("_a", "_b")).alias("_node")).distinct()
    texts = texts_of(wanted, reps, docs, id, text)
    side = lambda c: texts.select(F.col("_node").alias(f"_{c}"), F.col("_text").alias(f"_text_{c}"))
    # Sorted by _a last, so that a task meets a hub's pairs one after another.
    both = pairs.join(side("b"), "_b").join(side("a"), "_a").select("_a", "_b", "_text_a", "_text_b")
    with small_batches(docs.sparkSession):
        return keep(both.mapInArrow(lambda it: _verify(it, width, percent), "_a long, _b long"), "links")


def _sized(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Ordered, distinct pairs whose set sizes allow the similarity."""
    size = lambda c: reps.select(F.col("_node").alias(f"_{c}"), F.col("_size").alias(f"_size_{c}"))
    pairs = pairs.select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b")).distinct()
    able = F.expr(f"100 * least(_size_a, _size_b) >= {percent} * greatest(_size_a, _size_b)")
    return pairs.join(size("a"), "_a").join(size("b"), "_b").where(able).select("_a", "_b")


def star_pairs(buckets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Every class with the hubs of its buckets: linear in the entries, however full a bucket is."""
    pairs = buckets.where("_node != _hub").select(F.col("_hub").alias("_a"), F.col("_node").alias("_b"))
    return keep(_sized(pairs, reps, percent), "pairs")


# A task compares the classes of at most about two blocks of one bucket, or of several small
# buckets that hold about PACK entries together.
BLOCK, PACK = 256, 2_000


def _least(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The ``LEAST`` least 32-bit hashes of each text's shingles, ascending."""
    for batch in batches:
        sets = []
        for _, n, _, _, hashes, first in word_hashes(batch.column("_text"), NOT_SPACE):
            for k in range(n):
                short = (shingle_hashes(hashes[first[k] : first[k + 1]], width) >> np.uint64(32)).astype(np.uint32)
                sets.append(np.unique(short)[:LEAST].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("_node"), pa.array(sets, pa.binary())], ["_node", "_least"])


def _may_link(a: np.ndarray, b: np.ndarray, sizes: tuple[int, int], percent: int, least: float) -> bool:
    """Whether two sets may be linked, from their least hashes.

    If both are whole, the answer is exact but for equal hashes of unequal shingles, which only
    raise the similarity. Else the least hashes of the union are a sample of it.
    """
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    if max(sizes) <= LEAST:
        common = int(twice.sum())
        return 100 * common >= percent * (len(both) - common)
    new = np.concatenate([[True], ~twice])
    common = np.flatnonzero(twice)
    last = np.flatnonzero(new)[: min(len(a), len(b))][-1]
    seen = int((common < last + 1).sum())
    return seen >= least * int(new[: last + 1].sum())


def _compare(table: pa.Table, percent: int, bands: int, rows: int) -> pa.Table:
    """Pairs of a group's rows that share a bucket, are apart and may be linked.

    A pair that shares several buckets is given in the first of its bands only.
    """
    table = table.combine_chunks().sort_by([("_key", "ascending"), ("_node", "ascending")])
    column = lambda c: table.column(c).to_numpy()
    key, node, label, size, side, band = map(column, ("_key", "_node", "_label", "_size", "_side", "_band"))
    sketches = np.frombuffer(b"".join(table.column("_sketch").to_pylist()), np.uint8).reshape(len(key), -1)
    sets = [np.frombuffer(x, np.uint32) for x in table.column("_least").to_pylist()]
    p = percent / 100
    floor = lambda n: p - DEVIATIONS * float(np.sqrt(p * (1 - p) / n))
    stops = np.searchsorted(key, key, "right")
    out = [np.zeros((2, 0), np.int64)]
    for k in range(len(key)):
        rest = slice(k + 1, stops[k])
        # Side 2 is a block compared with itself; else only pairs across the two blocks count.
        apart = (label[rest] != label[k]) & ((side[rest] != side[k]) | (side[k] == 2))
        apart &= 100 * np.minimum(size[rest], size[k]) >= percent * np.maximum(size[rest], size[k])
        other = np.flatnonzero(apart) + k + 1
        if len(other):
            same = sketches[other] == sketches[k]
            shared = same[:, : bands * rows].reshape(len(other), bands, rows).all(axis=2)
            other = other[(same.mean(axis=1) >= floor(bands * rows)) & (shared.argmax(axis=1) == band[k])]
            near = [_may_link(sets[k], sets[j], (size[k], size[j]), percent, floor(LEAST)) for j in other]
            other = other[np.array(near, bool)]
            out.append(np.stack([np.full(len(other), node[k]), node[other]]))
    pairs = np.concatenate(out, axis=1)
    return pa.table({"_a": pairs[0], "_b": pairs[1]})


def rest_pairs(
    buckets: DataFrame, labels: DataFrame, reps: DataFrame, docs: DataFrame, id: str, text: str, width: int,
    percent: int, bands: int, rows: int,
) -> DataFrame:
    """Pairs that share a bucket but no component yet and that may be linked.

    Only buckets that hold several components remain. In a large one, the classes outside its largest
    component are cut into blocks, which meet each other and the blocks of that component; the
    latter do not meet, so a bucket of linked copies with a few strangers costs about its size. A pair
    comes out only if neither the sketches nor the least hashes of its sets rule it out; the latter are
    the whole sets of all but long texts, so hardly any pair comes out in vain.
    """
    entries = buckets.select("_key", "_band", "_node").join(labels, "_node", "left")
    entries = entries.withColumn("_label", F.coalesce("_label", "_node"))
    parts = entries.groupBy("_key", "_label").agg(F.count(F.lit(1)).alias("_c"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    open_ = (
        parts.groupBy("_key")
        .agg(F.sum("_c").alias("_n"), F.max(F.struct("_c", "_label")).alias("_main"), F.count(F.lit(1)).alias("_parts"))
        .where("_parts > 1")
        .select(
            "_key", "_n", F.col("_main._label").alias("_main"),
            blocks(F.col("_n") - F.col("_main._c")).alias("_others"), blocks(F.col("_main._c")).alias("_mains"),
        )
    )
    open_ = keep(open_, "open")
    small = open_.where(F.col("_n") <= BLOCK).agg(F.sum("_n")).first()[0] or 0
    members = keep(entries.join(open_, "_key"), "members")
    texts = texts_of(members.select("_node").distinct(), reps, docs, id, text)
    with small_batches(docs.sparkSession):
        sets = keep(texts.mapInArrow(lambda it: _least(it, width), "_node long, _least binary"), "sets")
    known = reps.select("_node", "_size", "_sketch").join(sets, "_node")

    # Groups (_pack, _i, _j): _j below 0 are blocks of the largest component, the others' blocks meet at _i <= _j.
    number = lambda n: F.sequence(F.lit(0), n - 1)
    place = lambda pack, i, j, side: F.struct(
        pack.cast("long").alias("_pack"), i.cast("int").alias("_i"), j.cast("int").alias("_j"), side.cast("int").alias("_side")
    )
    key, hashed = F.col("_key"), F.xxhash64("_node")
    mine, main = F.pmod(hashed, "_others"), F.pmod(hashed, "_mains")
    with_others = F.transform(
        number(F.col("_others")),
        lambda o: place(
            key, F.least(mine, o), F.greatest(mine, o),
            F.when(mine == o, F.lit(2)).otherwise((mine > o).cast("int")),
        ),
    )
    with_mains = F.transform(number(F.col("_mains")), lambda m: place(key, mine, -1 - m, F.lit(0)))
    of_main = F.transform(number(F.col("_others")), lambda o: place(key, o, -1 - main, F.lit(1)))
    together = F.array(place(F.pmod(F.xxhash64("_key"), F.lit(-(-small // PACK) or 1)), F.lit(-1), F.lit(0), F.lit(2)))
    groups = (
        F.when(F.col("_n") <= BLOCK, together)
        .when(F.col("_label") == F.col("_main"), of_main)
        .otherwise(F.concat(with_others, with_mains))
    )
    spread = members.withColumn("_g", F.explode(groups)).join(known, "_node").select(
        "_g.*", "_key", "_band", "_node", "_label", "_size", "_sketch", "_least"
    )
    return spread.groupBy("_pack", "_i", "_j").applyInArrow(
        lambda table: _compare(table, percent, bands, rows), "_a long, _b long"
    )


def components(edges: DataFrame) -> DataFrame:
    """(_node, _label) for all nodes of the edges (_a, _b); the label is the least node reachable.

    Each round hooks every node to its least neighbour, shortens the chains and contracts the
    graph; paths shrink to a quarter per round.
    """
    edges = keep(edges.distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("_b", "_a"))
        hook = both.groupBy(F.col("_a").alias("_node")).agg(F.least(F.first("_a"), F.min("_b")).alias("_up"))
        hook = keep(hook, "hooks")
        for _ in range(2):
            upper = hook.select(F.col("_node").alias("_up"), F.col("_up").alias("_top"))
            hook = hook.join(upper, "_up").select("_node", F.col("_top").alias("_up"))
        hook = keep(hook, "hooks")
        if labels is None:
            labels = hook.withColumnRenamed("_up", "_label")
        else:
            to = hook.select(F.col("_node").alias("_label"), "_up")
            moved = labels.join(to, "_label", "left")
            labels = keep(moved.select("_node", F.coalesce("_up", "_label").alias("_label")), "labels")
        a, b = (hook.select(F.col("_node").alias(f"_{c}"), F.col("_up").alias(f"_{c}2")) for c in "ab")
        moved = edges.join(a, "_a").join(b, "_b").where("_a2 != _b2")
        ends = F.least("_a2", "_b2").alias("_a"), F.greatest("_a2", "_b2").alias("_b")
        edges = keep(moved.select(*ends).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("_a").alias("_node"), F.col("_b").alias("_label"))
    return labels


def judge(
    docs: DataFrame, id: str, text: str, width: int, percent: int, bands: int, rows: int
) -> DataFrame:
    """``_id``, ``_hash``, ``_size``, ``_label`` and ``_component`` of every document.

    ``_label`` is the row number of one member; null for documents without words.
    """
    signed = signatures(docs, id, text, width, bands, rows)
    seen = signed.where("_size > 0")
    classes = keep(seen.groupBy("_print").agg(F.min("_row").alias("_node"), F.min("_id").alias("_least")), "classes")
    reps = keep(
        seen.join(classes.select(F.col("_node").alias("_row")), "_row", "left_semi")
        .select(F.col("_row").alias("_node"), "_id", "_hash", "_size", "_sketch"),
        "representatives",
    )
    buckets = shared_buckets(reps, bands, rows)
    first = star_pairs(buckets, reps, percent)
    links = confirm(first, reps, docs, id, text, width, percent)
    labels = components(links)
    more = rest_pairs(buckets, labels, reps, docs, id, text, width, percent, bands, rows)
    more = keep(more.join(first, ["_a", "_b"], "left_anti"), "pairs")
    more = confirm(more, reps, docs, id, text, width, percent)
    labels = components(links.union(more))

    member = classes.join(labels, "_node", "left").withColumn("_label", F.coalesce("_label", "_node"))
    least = member.groupBy("_label").agg(F.min("_least").alias("_component"))
    found = keep(member.join(least, "_label").select("_print", "_label", "_component"), "components")
    out = signed.select("_id", "_hash", "_size", "_print").join(found, "_print", "left").drop("_print")
    return out.withColumn("_component", F.when(F.col("_size") > 0, F.col("_component")).otherwise(F.col("_id")))


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Per document: ``id``, ``n_shingles``, ``component_id``, ``kept``.

    ``component_id`` is the least id reachable over links, ``kept`` marks the document that
    bears it. Null texts and texts without words are linked with nothing: they are their own
    component. Rows that repeat an id and a text are copies like any other; all rows that bear the
    least id are kept. A null id is kept only if its component has no other. An empty table
    gives an empty result.

    1. Equal sets are merged into classes by a SHA-256 of the sorted set (64-bit shingle hashes).
    2. Circulant MinHash: one permutation places a shingle on a circle, coordinate k reads a
       second permutation k places further. Bands of coordinates give buckets.
    3. Every class is compared with its buckets' hubs on the full sets; then, in buckets that
       still hold several components, the other pairs that sketches and least hashes do not rule out.
    4. Components by contraction.
    """
    judged = judge(docs, id, text, width, percent, bands, rows)
    return judged.select(
        F.col("_id").alias(id),
        F.col("_size").alias("n_shingles"),
        F.col("_component").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("_component")).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One document of each component, with the columns of ``docs``.

    It is the one with the least id, a null id last; if several texts bear that id, the one with
    the least text hash. Rows that repeat an id and a text count as one document, also where the
    text is null or has no words.
    """
    judged = judge(docs, id, text, width, percent, bands, rows)
    key = F.struct(F.col("_id").isNull().alias("_no_id"), "_id", "_hash")
    linked = judged.where("_size > 0").groupBy("_label").agg(F.min(key).alias("_k")).select("_k.*")
    alone = judged.where("_size = 0").select(key.alias("_k")).select("_k.*")
    zero = F.lit(0).cast(docs.schema[id].dataType)
    on = ["_near_id", "_near_no_id", "_near_hash"]
    named = (F.coalesce("_id", zero), F.col("_no_id"), F.col("_hash"))
    stays = linked.union(alone).select(*[c.alias(n) for c, n in zip(named, on)]).distinct()
    own = (F.coalesce(F.col(id), zero), F.col(id).isNull(), F.xxhash64(text))
    rows_in = docs.withColumns(dict(zip(on, own)))
    return rows_in.join(stays, on, "left_semi").dropDuplicates(on).select(*docs.columns)
