"""Every registered query against its SQL or a plain version, and the pipeline stage by stage."""

import os
import zlib

import brute
import pytest
from compare import connect, differences

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from regspan.llm.queries import ORACLES, QUERIES

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


def rows(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet").collect()


def test_all_operators_are_registered():
    assert [n.split("_")[0] for n in QUERIES] and {int(n.split("_")[0][2:]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, oracle, name):
    ours = QUERIES[name](spark, SF).toArrow()
    assert differences(ours, oracle.execute(ORACLES[name]).to_arrow_table()) == []


def test_quality(spark):
    found = QUERIES["op5_quality"](spark, SF).collect()
    docs = {r.doc_id for r in rows(spark, "documents")}
    assert {r.doc_id for r in found} == docs and len(found) == len(docs)
    quality = {r.doc_id: r.quality for r in rows(spark, "labels")}
    held = [r for r in found if r.held_out and r.doc_id in quality]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert sum(r.predicted == quality[r.doc_id] for r in held) >= 0.9 * len(held)


def test_tokens(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text or "" for r in rows(spark, "documents")}
    for r in QUERIES["op7_tokens"](spark, SF).collect():
        n = len(plain.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)


def test_main_text(spark):
    import html
    import re

    pages = {r.page_id: r for r in rows(spark, "pages")}
    for r in QUERIES["op9_html"](spark, SF).collect():
        article = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        want = " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, items = docs.columns, [(r.item_id, r.text) for r in rows(spark, "benchmark")]
    predicted = {r.doc_id: r.predicted for r in QUERIES["op5_quality"](spark, SF).collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.keep(stage(spark, docs, SF), name)
        if name == "quality_rules":
            want = [r.doc_id for r in before if not brute.fails_rules(r.text)]
        elif name == "quality_classifier":
            want = [r.doc_id for r in before if predicted[r.doc_id]]
        elif name == "near_duplicates":
            component, _ = brute.components([(r.doc_id, r.text) for r in before], 5)
            want = [r.doc_id for r, c in zip(before, component) if r.doc_id == c]
        elif name == "decontamination":
            want = [r.doc_id for r in before if not brute.passages(r.text, items)[3]]
        else:
            sizes = {}
            for r in before:
                sizes[r.source] = sizes.get(r.source, 0) + len(brute.words(r.text))
            targets, taken = brute.targets(sizes), {}
            for r in docs.collect():
                taken[r.source] = taken.get(r.source, 0) + len(brute.words(r.text))
            longest = max(len(brute.words(r.text)) for r in before)
            assert all(abs(taken.get(s, 0) - t) <= 2 * longest for s, t in targets.items())
            assert docs.columns == [*columns, "copy"]
            assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before}
            break
        assert docs.columns == columns
        assert sorted(r.doc_id for r in docs.collect()) == sorted(want), name
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "mixing"
    first = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, first.collect())) == sorted(map(str, docs.collect()))


def folder(spark, tmp_path, rows):
    """A folder like the given ones, with nulls, repeats and columns named like the operators' own."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string, SCORE double, copies int, _id string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 7 > 0), 0) for i in range(60)] + [(1, 1, 0), (None, 0, 0), (999, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [(1, "alpha " * 5 + "beta gamma delta epsilon zeta eta theta iota"), (None, None), (2, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_pipeline_on_odd_rows(spark, tmp_path):
    import random

    rng = random.Random(9)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(60, 140))) if i % 7 else "SPAM!! " * 80
        rows.append((i, text, "en", [None, "a", "b"][i % 3], len(text), "s", 0.5, 1, "x"))
    odd = [(None, None), (None, ""), (70, "\n \t"), (71, rows[1][1] + " more"), (None, rows[2][1]), (72, "alpha " * 60), (73, "y " * 40_000)]
    rows += [(i, t, None, None, None, None, None, None, None) for i, t in odd] + [rows[3], rows[3]]
    sf = folder(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.keep(stage(spark, docs, sf), name)
        assert docs.columns == columns
        assert docs.where("size IS NOT NULL AND size != 's'").count() == 0
    left = [(r.doc_id, r.text) for r in docs.collect()]
    component, _ = brute.components(left, 5)
    assert len(left) == len(set(component)) > 30
    assert {i for i, _ in left} <= set(range(60)) | {71}
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_pipeline_on_empty_tables(spark, tmp_path):
    sf = folder(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, sf).count() == 0
