"""Operators on documents against plain Python, with nulls, empty and long texts, ties and clashes."""

import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from regspan.llm import chat, decontaminate, minhash, mixing, quality, rules, tokens
from regspan.llm import quality as quality_module

random.seed(11)
VOCABULARY = [f"w{i}" for i in range(400)] + ["The", "ÉTÉ", "été", "naïve", "##", "a|b", "x"]


def prose(n, rng=random):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edited(text, k):
    w = text.split()
    for _ in range(k):
        w[random.randrange(len(w))] = f"e{random.randrange(10**6)}"
    return " ".join(w)


def corpus():
    base = [prose(n) for n in (80, 120, 200, 60)]
    texts = [*base]
    for b in base:
        texts += [b, b.upper(), b.replace(" ", " \n\t"), *(edited(b, k) for k in (1, 1, 2, 2, 3, 4, 6, 9, 12))]
    chain = base[0]
    for _ in range(6):  # a chain of copies of copies
        chain = edited(chain, 2)
        texts.append(chain)
    texts += [None, None, "", "", "  \n", "one", "one", "ONE", "a b c", "A b  c", "word " * 300, "word " * 500, prose(6000)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(3, texts[3]), (None, texts[0]), (None, "only here " + prose(40)), (None, None), (900, texts[-1])]
    random.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    extra = [(i, t, "en", None if k % 7 == 0 else f"s{k % 3}", k, "mine", "c") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(
        extra, "doc_id long, text string, lang string, source string, n_chars long, KEPT string, size string"
    ).repartition(5)


def empty(docs):
    return docs.where("false")


def key(r):
    return tuple((v is not None, v if v is not None else 0) for v in r)


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(docs, rows, width):
    found = minhash.near_duplicates(docs, width=width).collect()
    comp, sizes = brute.components(rows, width)
    want = [(i, n, c, i == c) for (i, _), n, c in zip(rows, sizes, comp)]
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_near_duplicates_in_blocks(spark, docs, rows, monkeypatch):
    """A family of copies in many small blocks and without help from hubs."""
    family = prose(150)
    many = [(i, edited(family, random.choice([3, 4, 5, 6]))) for i in range(120)]
    frame = spark.createDataFrame(many, "doc_id long, text string")
    want, _ = brute.components(many, 4)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "PACK", 40)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame, width=4).collect()}
    assert [got[i] for i, _ in many] == want


def test_one_of_each_component_stays(docs, rows):
    stays = minhash.drop_near_duplicates(docs)
    assert stays.columns == docs.columns
    comp, sizes = brute.components(rows, 5)
    got = [r.doc_id for r in stays.where(F.length(F.trim("text")) > 2).select("doc_id").collect()]
    want = {c for c, n, (_, t) in zip(comp, sizes, rows) if n and len(t.strip()) > 2}
    assert len(got) == len(set(got)) and set(got) == want
    assert stays.where("text IS NULL").count() == len({i for i, t in rows if t is None})


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = minhash.components(spark.createDataFrame(edges, "_a long, _b long")).collect()
    assert {r._node: r._label for r in found} == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}


def test_sketches_estimate_similarity():
    import numpy as np

    a = np.arange(1, 2000, dtype=np.uint64)
    from regspan.llm.words import mix

    x, y = mix(a[:1000]), mix(a[111:1111])  # 889 of 1111 in common
    same = np.mean(np.frombuffer(minhash.sketch(x, 1024), np.uint8) == np.frombuffer(minhash.sketch(y, 1024), np.uint8))
    assert abs(same - 889 / 1111) < 0.06


def test_near_duplicates_of_nothing(docs):
    assert minhash.near_duplicates(empty(docs)).count() == 0
    assert minhash.drop_near_duplicates(empty(docs)).columns == docs.columns


ITEMS = [
    (1, prose(30)), (2, "short item here"), (10, prose(13)), (10, "another text of ten " + prose(20)), (3, None), (4, ""),
    (None, "no id " + prose(15)), (5, "ÉTÉ a"), (6, "— … !"), (2, "short item here"),
]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.fixture(scope="module")
def tainted(spark):
    texts = [prose(40) + " " + t + " " + prose(40) for _, t in ITEMS if t]
    texts += [ITEMS[0][1].upper().replace(" ", "-"), "x Short  ITEM, here: y", prose(5000) + " " + ITEMS[2][1], "ÉTÉ A", "été a"]
    texts += [" ".join(ITEMS[0][1].split()[:12]), " ".join(ITEMS[0][1].split()[:14]) + " q", None, "", "字 " + ITEMS[2][1] + " é"]
    return spark.createDataFrame(list(enumerate([*texts, *texts])), "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_WINDOWS, 7])
def test_passages(tainted, benchmark, most):
    found = decontaminate.find_passages(tainted, benchmark, most=most).collect()
    assert len(found) == tainted.count()
    for r in found:
        want = brute.passages(r.text, ITEMS)
        assert (r.n_words, r.n_hit, set(r["items"]), r.contaminated) == want, r.text
        assert sum(s.words for s in r.spans) == r.n_hit
        for s in r.spans:
            assert len(brute.alphanumeric(r.text[s.start : s.end])) == s.words


def test_passages_are_cut_out(tainted, benchmark):
    clean = decontaminate.without_passages(tainted, benchmark)
    assert clean.columns == tainted.columns and clean.count() == tainted.count()
    left = {(r.doc_id, i): r.text for i, r in enumerate(sorted(clean.collect(), key=lambda r: (str(r.doc_id), r.text or "")))}
    spans = decontaminate.find_passages(tainted, benchmark).collect()
    want = []
    for r in spans:
        text, at, parts = r.text, 0, []
        for x in r.spans:
            parts.append(text[at : x.start])
            at = x.end
        want.append((str(r.doc_id), text if not r.spans else "".join(parts) + text[at:]))
    assert sorted((str(k[0]), v or "") for k, v in left.items()) == sorted((i, t or "") for i, t in want)
    assert any(r.spans for r in spans) and any(brute.passages(t, ITEMS)[1] < brute.passages(r.text, ITEMS)[1] for r, (_, t) in zip(spans, want))
    kept = decontaminate.without_contaminated(tainted, benchmark).collect()
    want = sorted(r.doc_id for r in tainted.collect() if not brute.passages(r.text, ITEMS)[3])
    assert sorted(r.doc_id for r in kept) == want


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_WINDOWS, 7])
def test_item_ids_of_any_type(spark, tainted, most):
    named = spark.createDataFrame([(None if i is None else f"item-{i}", t) for i, t in ITEMS], "item_id string, text string")
    found = decontaminate.find_passages(tainted, named, most=most)
    assert found.schema["items"].dataType.simpleString() == "array<string>"
    for r in found.collect():
        assert set(r["items"]) == {f"item-{i}" for i in brute.passages(r.text, ITEMS)[2]} and r["items"] == sorted(r["items"])


def test_a_passage_of_all_items_parts_the_benchmark(spark, tainted):
    """Blocks are cut by windows and their items, so a list of all ids counts as what it holds."""
    common = " ".join(f"common{i}" for i in range(13))
    items = spark.createDataFrame([(i, f"{common} own{i} words{i}") for i in range(200)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {common} y"), (2, "nothing of it")], "doc_id long, text string")
    found = {r.doc_id: r for r in decontaminate.find_passages(docs, items, most=50).collect()}
    assert found[1]["items"] == list(range(200)) and found[1].n_hit == 13 and not found[2]["items"]


def test_passages_with_clashing_columns_and_empty_tables(tainted, benchmark):
    odd = tainted.withColumn("SPANS", F.lit(1)).withColumn("n_hit", F.lit("x"))
    found = decontaminate.find_passages(odd, benchmark)
    assert sorted(found.columns) == sorted(["doc_id", "text", "n_words", "n_hit", "items", "spans", "contaminated"])
    assert decontaminate.without_contaminated(odd, benchmark).columns == odd.columns
    assert decontaminate.find_passages(tainted, benchmark.where("false")).where("n_hit > 0 OR contaminated").count() == 0
    assert decontaminate.find_passages(empty(tainted), benchmark).count() == 0


TEXTS = [
    None, "", " \n\t", "one", "a b c", "a b c a b c", "a a a a", "x x x", "The cat sat. The cat sat on the mat",
    "line one\nline two\nline one\n\n\nline one", "## $$ | <b>", "字 字 字 字 字", "A\x0bB\x0cC\rD", "  x  y",
    "w " * 3000, prose(3000), "\n".join(["same line here"] * 40), "LOUD " * 60 + prose(30), prose(49), prose(50), "é" * 30 + " " + prose(60),
]


def test_measures(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in rules.with_measures(frame).collect():
        assert {n: r[n] for n in rules.MEASURES} == brute.measures(r.text), r.text


def test_cascade(spark):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, Failed_Rule string")
    found = rules.cascade(frame)
    assert [c.lower() for c in found.columns].count("failed_rule") == 1
    for r in found.collect():
        assert (r.failed_rule is not None) == brute.fails_rules(r.text), r.text
    kept = rules.passing(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, t in enumerate(TEXTS) if not brute.fails_rules(t)]
    assert rules.cascade(frame.where("false")).count() == 0


def test_measures_that_are_not_known_are_computed_where_needed(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for shown in (["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"], ["n_words"]):
        measured = rules.with_measures(frame, names=shown)
        assert measured.columns == ["doc_id", "text", *shown]
        for r in rules.cascade(measured, known={n: n for n in shown}).collect():
            assert (r.failed_rule is not None) == brute.fails_rules(r.text), r.text


def test_rules_are_ordered_by_rejection_per_cost():
    a, b, c = (rules.Rule(n, lambda m: None) for n in "abc")
    failed = {0: 100, 1: 10, 2: 30, 4: 5, 6: 25}  # b fails 55, c 30 of which 25 also fail b
    cost = {"a": 1.0, "b": 1.0, "c": 0.4}
    assert [r.name for r in rules.ordered([a, b, c], cost, failed)] == ["c", "b", "a"]
    assert [r.name for r in rules.ordered([a, b, c], cost | {"c": 1.0}, failed)] == ["b", "a", "c"]


def test_native_operators_run_without_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    for frame in (rules.cascade(docs), rules.passing(docs), mixing.mix(docs), mixing.plan_mix(docs), chat.format_chats(turns)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Scan ExistingRDD", "NestedLoop", "Cartesian"))


def test_mix(docs, rows):
    found = mixing.plan_mix(docs, columns=["doc_id", "source", "text"]).collect()
    assert len(found) == len(rows)
    sizes = {}
    for r in found:
        assert r.size == len(brute.words(r.text)) and r.taken == r.copies * r.size and 0 <= r.copies <= 3
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = brute.targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    again = mixing.plan_mix(docs.repartition(3), columns=["doc_id", "source", "text"]).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


@pytest.mark.parametrize("cells", [50_000, 20])
def test_mix_comes_near_its_targets(spark, monkeypatch, cells):
    monkeypatch.setattr(mixing, "CELL_ROWS", cells)
    rng = random.Random(2)
    table = [(i, rng.choice(["hot"] * 6 + ["b", "c", "d", None]), prose(int(rng.paretovariate(1.2) * 10) % 400 + 1, rng)) for i in range(3000)]
    found = mixing.plan_mix(spark.createDataFrame(table, "doc_id long, source string, text string")).collect()
    taken, target = {}, {}
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) < 0.02 * target[s] + 400 for s in taken)
    mixed = mixing.mix(spark.createDataFrame(table, "doc_id long, source string, text string"))
    assert mixed.columns == ["doc_id", "source", "text", "copy"] and mixed.count() == sum(r.copies for r in found)


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 1}, {"a": 1, "b": 50, None: 100}, {"a": 0, "b": 10}, {"a": 4, "b": 4, "c": 4, "d": 4}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(s or "", s is None, n) for s, n in sizes.items()], "_source string, _none boolean, _size long")
    found = {None if r._none else r._source: r.target for r in mixing.targets(frame).collect()}
    assert found == pytest.approx(brute.targets(sizes))


def plain_statistics(text):
    """The classifier's statistics, letter by letter and word by word."""
    raw = (text or "").encode()
    w, n, size = [x.encode() for x in brute.words(text)], len(brute.words(text)), max(len(raw), 1)
    share = lambda chars: sum(c in chars for c in raw) / size
    three = [tuple(x.lower() for x in w[i : i + 3]) for i in range(max(n - 2, 0))] or ([tuple(w)] if w else [])
    times = Counter(three)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    words = Counter(x.lower() for x in w)
    letters = Counter(raw)
    return [
        math.log1p(n), (size - size * share(b" \t\n\v\f\r")) / max(n, 1), len(words) / max(n, 1), max(words.values(), default=0) / max(n, 1),
        sum(c for c in times.values() if c > 1) / max(sum(times.values()), 1), 1 - len(set(lines)) / max(len(lines), 1),
        math.log1p(n / max(len(lines), 1)), share(bytes(range(97, 123))), share(bytes(range(65, 91))), share(b"0123456789"), share(b" \t\n"),
        *[share(c) * size / max(n, 1) for c in (b".", b",;:", b"!?", b"|", b"#*$%&<>=~^{}[]\\/@_")], share(bytes(range(128, 256))),
        -sum(c / size * math.log2(c / size) for c in letters.values()),
    ]


def plain_scores(docs, quality):
    """Statistics, Fourier features, normal equations and pooling in plain NumPy, all rows at once."""
    x = {i: np.array(plain_statistics(t)) for i, t in docs}
    part = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in docs}
    known = [i for i, _ in docs if i in quality and part[i]]
    rng = np.random.default_rng(quality_module.SEED)
    directions = rng.normal(size=(18, 256)) / np.sqrt(18)
    phases = rng.uniform(0, 2 * np.pi, 256)
    a = np.array([x[i] for i in known])
    mean, spread = a.mean(axis=0), a.std(axis=0)
    spread = np.where(spread > 1e-6, spread, 1.0)

    def expand(rows):
        z = np.clip((np.atleast_2d(rows) - mean) / spread, -6, 6)
        return np.hstack([np.cos(z @ directions + phases) * np.sqrt(2 / 256), np.ones((len(z), 1))])

    fitted = [i for i in known if part[i] < 4]
    z, y = expand([x[i] for i in fitted]), np.array([quality[i] for i in fitted], float)
    penalty = np.eye(257) * 1e-3 * len(fitted)
    penalty[-1, -1] = 1e-9
    weights = np.linalg.solve(z.T @ z + penalty, z.T @ y)
    bins = {}
    for i in known:
        if part[i] == 4:
            raw = float((expand(x[i]) @ weights)[0])
            bins.setdefault(int(np.clip(math.floor((raw + 0.5) * 200), -1, 400)), []).append((raw, quality[i]))
    pooled = []
    for k in sorted(bins):
        pooled.append([np.mean([r for r, _ in bins[k]]), np.mean([q for _, q in bins[k]]), len(bins[k])])
        while len(pooled) > 1 and pooled[-2][1] >= pooled[-1][1]:
            (p, q, m), (r, s, n) = pooled[-2], pooled[-1]
            pooled[-2:] = [[(p * m + r * n) / (m + n), (q * m + s * n) / (m + n), m + n]]
    out = {}
    for i, _ in docs:
        raw = float((expand(x[i]) @ weights)[0])
        level = np.interp(raw, [p[0] for p in pooled], [p[1] for p in pooled])
        out[i] = 0.999 * level + 0.001 * min(max((raw + 1) / 3, 0), 1)
    return out


def test_scores_equal_a_plain_computation(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_scores(rows, {r.doc_id: int(r.quality > 0) for r in labels.collect() if r.quality is not None})
    found = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    assert len(found) == len(rows) > 100
    assert max(abs(found[i] - want[i]) for i in found) < 1e-5
    kept = {r.doc_id for r in quality.passing(docs, labels).collect()}
    assert kept == {i for i, v in found.items() if v >= quality.THRESHOLD}


def test_only_labelled_texts_are_read_for_fitting(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 100, 2)] * 2 + [(3, None), (None, 1), (500, 0)], "doc_id long, quality int")
    some = {r.doc_id for r in quality.labelled(docs, labels, "doc_id", "quality", 1000).collect()}
    assert some == {i for i in range(0, 100, 2) if zlib.crc32(str(i).encode()) % 5}
    fewer = {r.doc_id for r in quality.labelled(docs, labels, "doc_id", "quality", 10).collect()}
    assert fewer < some and len(fewer) < 25


def test_remembered_pieces_are_bounded_in_bytes():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    counter = tokens.Counter(tokenizer, most=20_000)
    rng = random.Random(3)
    for _ in range(20):
        texts = ["".join(rng.choice("天地玄黃宇宙洪荒") for _ in range(3000)), " ".join(f"w{rng.randrange(10**6)}" for _ in range(80)), "a b\nc"]
        assert counter.counts(texts) == [len(tokenizer.encode(t, add_special_tokens=False)) for t in texts]
        assert sum(len(p) for p in counter.known) * 4 < 60_000 and max(map(len, counter.known)) <= 64


def test_other_tokenizer_files_encode_whole_texts(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    assert not tokens.cuts_hold(plain) and tokens.cuts_hold(Tokenizer.from_file(public.path("byte_bpe_50k.json")))
    texts = ["It's  here,\n\nthen 1234 gone ", "x " * 200, "", None, "<|endoftext|> a\tb"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in tokens.count_tokens(frame, path, chunk=20, overlap=4).collect():
        assert r.n_tokens == len(plain.encode(r.text or "", add_special_tokens=False))


def test_a_million_cells_of_one_source(spark):
    """Sums run over classes, then over the cells of one class; no window holds the cells of a source."""
    n = 1_000_000
    cells = spark.range(n).select(
        F.lit("hot").alias("_source"), F.lit(False).alias("_none"), (F.col("id") % 200).cast("int").alias("_class"),
        F.lpad(F.hex(F.floor(F.col("id") / 200)), 4, "0").alias("_cell"), (F.col("id") % 7).alias("_n"),
    )
    found = mixing.cell_starts(cells)
    windows = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
    assert len(windows) == 2 and any(re.search(r"windowspecdefinition\(_class#\d+, _cell", x) for x in windows)
    rows = cells.groupBy("_class").agg(F.sum("_n").alias("n")).orderBy("_class").collect()
    starts = found.groupBy("_class").agg(F.min("_before").alias("low"), F.max(F.col("_before") + F.col("_n")).alias("high"), F.count(F.lit(1)).alias("c"))
    at = 0
    for r, s in zip(rows, starts.orderBy("_class").collect()):
        assert (s.low, s.high, s.c) == (at, at + r.n, n // 200)
        at += r.n


def test_mix_of_nothing(spark, docs):
    assert mixing.plan_mix(empty(docs)).count() == 0
    silent = spark.createDataFrame([(1, None, None), (2, "a", " ")], "doc_id long, source string, text string")
    assert [(r.size, r.target, r.taken) for r in mixing.plan_mix(silent).collect()] == [(0, 0.0, 0)] * 2


@pytest.fixture(scope="module")
def marked(spark):
    rng = random.Random(4)
    texts = []
    for i in range(900):
        good = prose(rng.randrange(20, 200), rng) + "."
        kind = i % 6
        bad = [good.upper() + "!!", " | ".join(good.split()), "spam " * rng.randrange(20, 200)][i % 3]
        texts.append((i, bad if kind in (0, 1) else good, 0 if kind in (0, 1) else 1))
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts] + [(None, None), (5000, ""), (5001, None), (5000, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in texts if i % 5 < 3] + [(7777, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    return docs, labels, {i: q for i, _, q in texts}


def test_classifier_on_held_out_documents(marked):
    docs, labels, truth = marked
    found = quality.classify(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    import zlib

    held = [r for r in found if r.doc_id in truth and r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(r.predicted == (r.score >= 0.3) for r in found)
    again = {r.doc_id: r.score for r in quality.classify(docs.repartition(7), labels).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score, abs=1e-9) for r in found)


def test_classifier_ignores_held_out_labels(marked):
    docs, labels, _ = marked
    held = quality.fold(F.col("doc_id")) == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({str(r.doc_id): r.score for r in quality.classify(docs, x).collect()} for x in (labels, turned))
    assert a == pytest.approx(b, abs=1e-9)


def test_classifier_keeps_columns_and_copes_with_few_labels(marked):
    docs, labels, truth = marked
    odd = docs.withColumn("score", F.lit("x")).withColumn("_x", F.lit(1))
    kept = quality.passing(odd, labels)
    assert kept.columns == odd.columns
    scored = {r.doc_id for r in quality.classify(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == scored
    assert {round(r.score, 2) for r in quality.classify(docs, labels.where("false")).collect()} == {0.5}
    assert quality.classify(docs, labels.where("quality = 1")).where("score < 0.3").count() == 0
    assert quality.classify(docs.where("false"), labels).count() == 0
    assert quality.classify(docs, labels, most=100).count() == docs.count()


def test_isotonic_is_monotone():
    import numpy as np

    x, y = quality.isotonic(np.arange(6.0), np.array([0.1, 0.5, 0.3, 0.3, 0.9, 0.8]), np.array([1.0, 1, 1, 2, 1, 3]))
    assert list(np.round(y, 4)) == [0.1, 0.35, 0.825] and list(x) == [0, 2.25, 4.75]


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json")


PIECES = ["the", "Hello", " ", "  ", "\n", "\n\n", "é", "字字", "'s", "don't", "12345", "!!!", "<|endoftext|>", "<|endof", "\t", "😀", "\x1c", "\r\n", " "]


def test_tokens(spark, tokenizer):
    from tokenizers import Tokenizer

    rng = random.Random(6)
    texts = [None, "", " ", "x" * 900, "字" * 500, "<|endoftext|>", *(
        "".join(rng.choice(PIECES) + rng.choice(["", " "]) for _ in range(rng.choice([1, 5, 60, 700]))) for _ in range(150)
    )]
    plain = Tokenizer.from_file(tokenizer)
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, N_TOKENS long")
    found = tokens.count_tokens(frame, tokenizer, chunk=200, overlap=8)
    assert found.columns == ["doc_id", "text", "n_bytes", "n_tokens"]
    for r in found.collect():
        text = r.text or ""
        assert r.n_tokens == len(plain.encode(text, add_special_tokens=False).ids), repr(text[:60])
        assert r.n_bytes == len(text.encode())
    assert tokens.count_tokens(frame.where("false"), tokenizer).count() == 0


def test_overlaps_widen_until_they_align(tokenizer):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer)
    rng = random.Random(8)
    for gap in (3, 40, 300, 5000):  # white space only every so many characters
        text = " ".join("".join(rng.choice("abcdé字12") for _ in range(gap)) for _ in range(12_000 // gap + 1))
        for chunk, overlap in ((64, 4), (500, 16), (1000, 900)):
            assert tokens.count_long(plain, text, chunk, overlap) == len(plain.encode(text, add_special_tokens=False).ids)


def test_least_hashes_rule_out_no_link():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (40, 400, 5000):
        for _ in range(30):
            base = rng.choice(2**32, n + 200, replace=False).astype(np.uint32)
            shared = rng.integers(int(n * 0.6), n)
            a, b = np.sort(base[:n]), np.sort(np.concatenate([base[:shared], base[n : n + min(200, n - shared)]]))
            similarity = shared / (len(a) + len(b) - shared)
            left, right = a[: minhash.LEAST], b[: minhash.LEAST]
            floor = 0.8 - minhash.DEVIATIONS * (0.16 / minhash.LEAST) ** 0.5
            may = minhash._may_link(left, right, (len(a), len(b)), 80, floor)
            assert may or similarity < 0.8
            if max(len(a), len(b)) <= minhash.LEAST:
                assert may == (100 * shared >= 80 * (len(a) + len(b) - shared))
            assert not may or similarity > 0.6
