"""Pages of a batch are read together, once for document and storage, as the parser reads them one by one."""

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__  # noqa: F401  registers all queries
from rankwell.functions import text
from rankwell.operators import extract
from rankwell.plans.queries import QUERIES

BLOCK = '<div class="match-bm x"><a title="T 1">T<br>1</a><p>open<span data-timestamp="">s</div>tail</q>'
NESTED = '<p>a</p><div class="y match-bm"><a title="é‑">b</a><div class="match-bm-match-additional">h<div class="match-bm-match-additional">i</div></div><i src="x" class="match-bm-players-player"></i></div><b>c</b>'
PAGES = [
    None, "", "match-bm", BLOCK, NESTED, f"<p>{NESTED}", f"{NESTED}<p", NESTED.replace("b</a>", "b > c</a>"), NESTED.replace("é‑", "it's"), NESTED.replace("</i>", ""), NESTED + "&amp;", NESTED.replace('title="é‑"', 'title="x" title="y"'),
    '<br class="match-bm">', '<div class="match-bm match-bm-match-additional">a</div>', NESTED.replace("<i ", "<p\n"), NESTED.replace('"x"', '"x>y"'), "<div class='match&#45;bm'>x</div>", "<div class='match&#x2D;bm'>x</div>", NESTED.upper(), NESTED * 2, f"<script>{NESTED}</script>",
]


def told(reading):
    held, items = list(reading.numbers), np.concatenate(reading.items, axis=1)
    items = items[:, np.argsort(items[0], kind="stable")].T.tolist()
    return reading.texts, reading.stored().to_pylist(), [(*i[:5], held[i[5]]) for i in items]


def test_pages_together_are_read_as_the_parser_reads_them():
    class Parsed(extract.Reading):
        def _plain(self, pages):
            return pages[:0]

    whole = pa.array(PAGES, pa.string())
    for batch in (whole, *[whole.slice(i, 1) for i in range(len(PAGES))], whole.slice(3, 5)):
        assert told(extract.Reading(batch, True)) == told(Parsed(batch, True)), batch.to_pylist()
    texts, stored, _ = told(extract.Reading(whole, True))
    assert [i for i, t in enumerate(texts) if t is None] == [i for i, p in enumerate(PAGES) if extract.block_items(p) in (None, {"text": None, "items": None})]
    assert stored[4] == '<div class="y match-bm"><a title="é‑">b</a><i class="match-bm-players-player"></i></div>'


def test_plain_pages_are_not_parsed_one_by_one(monkeypatch):
    def parsed(*_):
        raise AssertionError("the parser was called")

    monkeypatch.setattr(extract.Page, "__init__", parsed)
    assert extract.Reading(pa.array([NESTED, f"<html>{NESTED}</html>", None, "<p>none</p> &amp;"]), True).texts == ["bhi", "bhi", None, None]


def test_batches_are_cut_by_bytes(spark, monkeypatch):
    whole, kind = pa.array(PAGES, pa.string()), extract.to_arrow_type(extract.struct(extract._PAGE))
    once = extract.read_pages(whole, kind, True)
    monkeypatch.setattr(extract, "BYTES_AT_ONCE", 100)
    assert extract.read_pages(whole, kind, True).equals(once) and once.type == kind and extract.read_pages(whole.slice(0, 0), kind).equals(once.slice(0, 0))


def test_stored_pages_lose_heavy_attributes_as_the_expression_has_it(spark):
    page = '<div class="match-bm"><img src="a" alt="b"\tstyle="c" data-src="d"> width="1"  height="2"<i\nloading="e">x</i></div>'
    (row,) = spark.createDataFrame([(page,)], "html string").select(extract.slim_pages("html").alias("slim"), text.slim_html(extract.F.lit(extract.Page(page).source(extract.Page(page).block("match-bm"), "none"))).alias("plain")).collect()
    assert row.slim == row.plain


@pytest.mark.parametrize(("name", "readings"), [("stored_pages", 2), ("reparse_all_pages", 3), ("reparse_spoiled_pages", 2)])
def test_a_page_is_read_once_for_document_and_storage(spark, name, readings):
    """Both branches of a union have the first reading; what is read again is the stored page."""
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == readings and "to_json(__again" not in plan
