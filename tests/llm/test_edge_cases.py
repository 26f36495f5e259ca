"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import importlib
import zlib

import pytest
from pyspark.sql import functions as F

from rankwell.llm import ann, bpe, cotrain, htmldiff, iblt, licenses, mixing, simhash, tokenfile, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, fp string, ids string, row int, `next` string, `target` string, label int"


def rows():
    long = "word other thing again " * 20_000
    body = [(1, "Hello world you idiot.\nSecond line"), (2, None), (3, ""), (4, long), (5, "same text here now ok"), (6, "same text here now ok"), (6, "same text here now ok"), (None, "no id at all"), (7, " \t\n"), (8, "🎉 é İstanbul 日本語 ﬁ x\x1cy"), (9, "x" * 50_000)]
    return [(i, t, None if i == 2 else "en", None if i in (3, 4) else f"s{(i or 0) % 3}", None, 1.0, 2, "f", "i", 3, "n", "t", 1) for i, t in body]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, None, 1), (5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def texts():
    return sorted(((i, t or "") for i, t, *_ in rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_licenses(spark, docs, none):
    got = licenses.op1_license_scan(spark, docs).collect()
    assert sorted((r.doc_id or 0, r.n_words) for r in got)[-3:] == [(7, 0), (8, 7), (9, 1)] and len(got) == 11
    assert all(r.n_base == 0 and r.first_word is None and r.labels == "" and r.score == 0 for r in got)
    assert licenses.op1_license_scan(spark, none).count() == 0


def test_toxicity_without_usable_labels(spark, docs, none, labels):
    got = {r.doc_id: r for r in toxicity.op3_toxicity_gbt(spark, docs, labels).collect()}
    assert got[2].score == 0 and got[1].score > 0 and all(0 <= r.score <= 1 for r in got.values())
    assert toxicity.op3_toxicity_gbt(spark, none, labels).count() == 0
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 10


def test_quality_without_usable_labels(spark, docs, none, labels):
    got = cotrain.op5_cotrain_quality(spark, docs, labels).collect()
    assert len(got) == 11 and all(r.predicted == 1 for r in got)
    assert cotrain.op5_cotrain_quality(spark, none, labels).count() == 0
    assert cotrain.reject_poor(docs, labels).columns == docs.columns


def test_token_file(spark, docs, none):
    got = sorted(tokenfile.op4_simple8b_tokens(spark, docs).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i for i, _ in texts()]
    assert got[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))
    assert {r.n_tokens for r in got if r.doc_id in (2, 3, 7)} == {1}
    assert {r.ids_crc32 for r in got if r.doc_id == 2} == {zlib.crc32((2).to_bytes(4, "little"))}
    assert tokenfile.op4_simple8b_tokens(spark, none).count() == 0


def test_byte_bpe(spark, docs, none):
    got = bpe.op6_byte_bpe(spark, docs).collect()
    assert sorted(r.decoded_sha256 for r in got) == sorted(hashlib.sha256(t.encode()).hexdigest() for _, t in texts())
    assert {(r.n_tokens, r.ids_sha256) for r in got if r.doc_id in (2, 3)} == {(0, hashlib.sha256(b"").hexdigest())}
    assert bpe.op6_byte_bpe(spark, none).count() == 0


def test_fingerprints(spark, docs, none):
    got = iblt.op7_iblt_fingerprint(spark, docs).collect()
    assert len(got) == 11 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    order = [t for _, t in texts()]
    edited = [t[: len(t) - len(t) // 2] + order[(k + 1) % len(order)][: len(t) // 2] for k, t in enumerate(order)]
    assert sorted(r.edited_sha256 for r in got) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in edited)
    assert len({r.fingerprint for r in got if r.doc_id in (5, 6)}) == 1 and len({r.fingerprint for r in got if r.doc_id in (2, 3)}) == 1
    assert iblt.op7_iblt_fingerprint(spark, none).count() == 0
    alone = iblt.op7_iblt_fingerprint(spark, docs.filter("doc_id = 1")).first()
    assert alone.near_next == 1


def test_mixing(spark, docs, none):
    got = mixing.op8_pivotal_mix(spark, docs).collect()
    assert len(got) == 11 and all(0 <= r.taken <= 3 * r["size"] for r in got)
    total = sum(r["size"] for r in got)
    assert total == 80_000 + 6 + 3 * 5 + 4 + 6 + 1
    assert abs(sum({r.source_size: r.target for r in got}.values()) - total) < 1e-6 * total
    again = mixing.op8_pivotal_mix(spark, docs.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.op8_pivotal_mix(spark, none).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_simhash(spark, docs, none):
    got = simhash.op10_simhash_gray(spark, docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 11 and {by[i].component_id for i in (2, 3, 7)} == {2} and by[2].fingerprint == "0" * 16
    assert by[5].component_id == by[6].component_id == 5 and by[4].component_id == 4
    assert simhash.op10_simhash_gray(spark, none).count() == 0


def test_html(spark):
    schema = "page_id long, url string, html string, text int"
    page = "<html><body><div>Menu of site</div><div>{}</div><div>Imprint</div></body></html>"
    some = [(1, "http://h/a/1", page.format("One &amp; only")), (2, "http://h/a/2", page.format("Two")), (3, None, page.format("Three")), (4, "http://h/b", None), (5, "", ""), (5, "", ""), (6, "http://other/x", page.format("Alone"))]
    got = {r.page_id: r.text for r in htmldiff.op9_html_url_diff(spark, spark.createDataFrame([(*r, 1) for r in some], schema)).collect()}
    assert got[1] == "One & only" and got[2] == "Two" and got[4] == got[5] == "" and "Menu of site" in got[3] and "Alone" in got[6]
    assert htmldiff.op9_html_url_diff(spark, spark.createDataFrame([], schema)).count() == 0


def test_neighbours(spark):
    schema = "vec_id long, embedding array<float>, score int"
    nan = float("nan")
    some = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [float("inf"), 1.0]), (8, [1.0]), (9, []), (20, [0.0, -2.0]), (20, [0.0, -2.0]), (None, [1.0, 1.0])]
    got = [tuple(r) for r in ann.op2_collision_ann(spark, spark.createDataFrame([(*r, 1) for r in some], schema)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, -1.0), (20, 3, 2, -1.0)]
    assert ann.op2_collision_ann(spark, spark.createDataFrame([], schema)).count() == 0


def test_pipeline_stages_keep_columns(spark, docs, labels, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    near = pipeline.drop_near_copies(spark, docs, str(tmp_path))
    assert sorted(r.doc_id or 0 for r in near.select("doc_id").collect()) == [0, 1, 2, 4, 5, 8, 9]


def test_every_operator_reads_a_table_without_rows_of_interest(spark, docs):
    some = docs.filter(F.col("doc_id") == 2)
    assert simhash.op10_simhash_gray(spark, some).first().component_id == 2
    assert mixing.op8_pivotal_mix(spark, some).first().taken == 0
