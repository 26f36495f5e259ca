"""Contamination against plain Python, the SQL of the query, and odd input."""

import hashlib
import random
import re

import duckdb
import pytest

from rankwell.llm import decontamination as dec
from rankwell.llm import queries

SMALL = "/root/testdata/sf0.001"
DOCS, ITEMS = "doc_id long, text string, n_words int, spans string, items string, row int", "item_id string, text string, lang string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document, window by window."""
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if (held := windows.get(tuple(w[i : i + k]))) is not None:
                    hit.update(range(i, i + k))
                    found |= held
        named = sorted(found - {None})
        out.append((doc, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def made(spark, docs, items):
    left = spark.createDataFrame([(i, t, 1, "s", "i", 2) for i, t in docs], DOCS).repartition(3)
    right = spark.createDataFrame([(i, t, "en") for i, t in items], ITEMS)
    return left, right


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    got = queries.queries()["op11_aho_decontamination"](spark, SMALL)
    expected = con.sql(queries.oracle_sql()["op11_aho_decontamination"])
    rows = sorted(tuple(r) for r in got.select(*expected.columns).collect())
    assert rows == sorted(expected.fetchall()) and any(r[-1] for r in rows)


@pytest.mark.parametrize("parts", [1, 3])
def test_random_texts_against_windows(spark, monkeypatch, parts):
    """Few words, so that windows overlap, repeat and belong to several items; short items; several automata and passes."""
    draw = random.Random(5)
    text = lambda n: draw.choice([" ", ", ", "\n"]).join(draw.choice(["a", "B", "é", "7"]) for _ in range(n))
    items = [(f"q{i % 30}", text(draw.choice([0, 9, 10, 12, 14, 30]))) for i in range(40)] + [(None, text(12)), ("none", None), ("dots", "...")]
    docs = [(i, text(draw.choice([0, 3, 12, 60, 400]))) for i in range(80)] + [(None, text(50)), (5, text(50)), (900, None), (901, items[5][1])]
    left, right = made(spark, docs, items)
    limit = dec.BROADCAST
    if parts > 1:
        monkeypatch.setattr(dec, "WINDOWS", 25)
        limit = 400
    found = dec.find_contamination(left, right, limit=limit).collect()
    shown = [(r.doc_id, r.n_words, sum(s.end - s.first for s in r.spans), len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), bool(r.spans)) for r in found]
    assert sorted(shown, key=str) == plain(docs, items)


def test_spans_name_the_original_text(spark):
    item = "What is the tallest mountain that rises on the island of Crete?"
    text = "İstanbul — 日本. WHAT is the tallest... mountain, that rises on the\nIsland of CRETE? Nobody."
    left, right = made(spark, [(1, text)], [("q", item)])
    row = dec.find_contamination(left, right).first()
    (span,) = row.spans
    assert text[span.begin_at : span.end_at] == text[text.index("WHAT") : text.index("?")]
    assert row["items"] == ["q"] and words(text)[span.first : span.end] == words(item)


def test_short_items_and_offsets(spark):
    left, right = made(spark, [(1, "x Café au  LAIT! y"), (2, "cafe au lait")], [("short", "café au lait")])
    one, two = sorted(dec.find_contamination(left, right).collect(), key=lambda r: r.doc_id)
    (span,) = one.spans
    assert "x Café au  LAIT! y"[span.begin_at : span.end_at] == "Café au  LAIT" and (span.first, span.end, one["items"]) == (1, 4, ["short"])
    assert two.spans == [] and two["items"] == []


def test_empty_and_very_long(spark):
    left, right = made(spark, [(1, "a " * 1_000_000), (2, "")], [("q", "a " * 11)])
    rows = {r.doc_id: r for r in dec.op11_aho_decontamination(spark, left, right).collect()}
    assert (rows[1].n_hit, rows[1].n_items, rows[2].n_words) == (1_000_000, 1, 0)
    assert dec.op11_aho_decontamination(spark, left.limit(0), right).count() == 0
    assert [r.contaminated for r in dec.op11_aho_decontamination(spark, left, right.limit(0)).collect()] == [False, False]
