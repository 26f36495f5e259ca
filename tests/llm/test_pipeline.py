"""The pipeline against its operators' decisions and plain Python on a small table."""

import hashlib
import importlib
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from rankwell.llm import cotrain, toxicity

SMALL = "/root/testdata/sf0.001"


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.fixture(scope="module")
def pipeline():
    return importlib.import_module("corpus_pipeline")


def test_whole_run(spark, pipeline):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    # what the two classifiers decide, each on its own input
    scored = toxicity.fit(docs, labels).score(docs).filter(F.col("score") < toxicity.THRESHOLD).drop("score").cache()
    model = cotrain.fit(scored, labels)
    good = scored.filter(model.score(F.col("text"), F.col("source"), F.col("lang"), F.col("n_chars"))["score"] >= cotrain.THRESHOLD)
    names = {r.doc_id: r.doc_id for r in good.collect()}
    # one document of each class of near copies, by comparing all pairs
    fps = {i: fingerprint(text[i]) for i in names}
    changed = True
    while changed:
        changed = False
        for i in fps:
            least = min(names[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 4)
            changed |= least != names[i]
            names[i] = least
    kept = {i for i in names if names[i] == i}
    # the mix of what is left
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", text[i])) for i in kept}
    by = Counter()
    for i in kept:
        by[source[i]] += size[i]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(by))}
    target, free, left = {}, set(by), by.total()
    while over := {s for s in free if left * weight[s] / sum(weight[f] for f in free) > 3 * by[s]}:
        target |= {s: 3 * by[s] for s in over}
        free -= over
        left = by.total() - sum(target.values())
    target |= {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
    rows = pipeline.run(spark, SMALL).collect()
    copies = Counter(r.doc_id for r in rows)
    assert set(copies) <= kept and max(copies.values()) <= 3
    for s in by:
        taken = sum(size[i] * n for i, n in copies.items() if source[i] == s)
        assert abs(taken - target[s]) <= 0.5 * max(size[i] for i in kept if source[i] == s) + 1e-6
    assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() for r in rows)
    assert {(r.doc_id, r.ids_sha256) for r in rows} == {(r.doc_id, r.ids_sha256) for r in pipeline.STAGES[-1][1](spark, docs, SMALL).collect() if r.doc_id in copies}


def test_clean_documents_stay(spark, pipeline):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = docs.join(spark.read.parquet(f"{folder}/labels.parquet").filter("toxic = 0 and quality = 1"), "doc_id", "left_semi")
    first = pipeline.drop_toxic(spark, docs, folder).cache()
    second = pipeline.drop_poor(spark, first, folder)
    assert first.join(clean, "doc_id", "left_semi").count() >= 0.98 * clean.count()
    assert second.join(clean, "doc_id", "left_semi").count() >= 0.96 * clean.count()


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(spark):
    long = " ".join(f"word{i % 977} is here" for i in range(60_000)) + 40_000 * " " + "end"
    texts = [(1, "Some plain words of a text that is long enough to be read by all."), (2, None), (3, ""), (4, long), (5, "twice the same text here now"), (5, "twice the same text here now"), (6, "\n\t  \n"), (7, "🎉 é İstanbul \x01\x7f"), (None, "a text without any id"), (None, None)]
    return spark.createDataFrame([(i, t, None if i == 2 else "en", None if i in (3, 7) else f"s{(i or 0) % 2}", None if i == 1 else len(t or "")) for i, t in texts], DOCUMENTS).repartition(3)


@pytest.mark.parametrize("name", ["toxicity", "quality", "near_duplicates", "mixing", "byte_bpe"])
def test_every_stage_takes_odd_and_empty_tables(spark, pipeline, name):
    stage = dict(pipeline.STAGES)[name]
    folder, docs = "/root/testdata/sf0.001", odd_documents(spark).withColumn("score", F.lit(1)).withColumn("ids", F.lit("x"))
    rows = stage(spark, docs, folder).collect()
    none = stage(spark, spark.createDataFrame([], docs.schema), folder)
    last = name == pipeline.STAGES[-1][0]
    assert none.count() == 0 and (last or none.columns == docs.columns)
    if last:
        want = sorted((r.doc_id or -1, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect())
        assert sorted((r.doc_id or -1, r.decoded_sha256) for r in rows) == want
    else:
        left = Counter((r.doc_id, r.text) for r in docs.collect())
        got = Counter((r.doc_id, r.text) for r in rows)
        assert rows[0].score == 1 and set(got) <= set(left) and (name == "mixing" or not got - left)
    if name == "near_duplicates":
        assert got[5, "twice the same text here now"] == 1 and sum(n for (i, _), n in got.items() if i is None) == 2 and got[4, docs.filter("doc_id = 4").first().text] == 1
