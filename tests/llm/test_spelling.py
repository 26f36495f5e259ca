"""Spelling variants against all pairs of words in plain Python, crowded halves, and odd input."""

import random
import re
import zlib
from collections import Counter

import pytest

from rankwell.llm import queries, spelling
from rankwell.llm.fmindex import Index

SMALL = "/root/testdata/sf0.001"


def counted(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def plain(words):
    """word, form, root, n, n_near, form_n by comparing all pairs."""
    form = {}
    out = []
    for w, n in words.items():
        near = [v for v in words if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
        out.append((w, form[w], n, len(near)))
    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, f, root(w), n, near, words[f] if f else None) for w, f, n, near in out)


def rows(frame):
    return sorted(tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_query_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    expected = plain(counted(docs))
    assert rows(queries.queries()["op12_spelling_variants"](spark, SMALL)) == expected and len(expected) > 100


@pytest.mark.parametrize("block", [4, 16_384])
def test_dense_words_against_all_pairs(spark, block):
    """A small alphabet, so that words have many near words, halves are crowded, and forms lead on over several steps."""
    draw = random.Random(9)
    words = {"".join(draw.choice("abÿ") for _ in range(draw.choice([6, 6, 7, 8]))): 5 ** draw.randrange(1, 7) + draw.randrange(3) for _ in range(150)}
    words |= {"aaaaaa": 3, "aaaaaaa": 15, "aaaaaaaa": 75, "zzzzzz": 9}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert rows(spelling.variants(frame, block=block)) == plain(words)


def test_index_finds_each_pair_once():
    draw = random.Random(2)
    for _ in range(20):
        words = sorted({"".join(draw.choice("abé") for _ in range(draw.choice([2, 3, 6, 7, 8, 9]))) for _ in range(draw.choice([1, 5, 90]))})
        asked = [*words, "zzzzzz", "aaazaa", "azzzzza"]
        found = [pair for side in "ps" for pair in zip(*[x.tolist() for x in Index(words).near(asked, side)], strict=True)]
        assert sorted(found) == [(i, j) for i, a in enumerate(asked) for j, b in enumerate(words) if one_edit(a, b)]
    long = ["x" * 3000, "x" * 3001, "x" * 2000 + "y" + "x" * 999]
    assert sum(len(Index(sorted(long)).near(long, side)[0]) for side in "ps") == 4


def test_odd_input(spark):
    schema = "doc_id long, text string, word string, n int, form string, lang string"
    body = [(1, None), (2, ""), (3, "LETTER letter Letter LETTER letter lettér"), (None, "letter " * 30 + "123 ×÷ " + "lette " * 5), (4, "étéété "), (4, "étéété " * 5), (4, "x" * 2_000_000)]
    docs = spark.createDataFrame([(i, t, "w", 1, "f", "en") for i, t in body], schema).repartition(3)
    got = {r.word: r for r in spelling.op12_spelling_variants(spark, docs).collect()}
    expected = counted([("" if i is None else i, t) for i, t in body])
    assert {w: r.n for w, r in got.items()} == expected and "letter" in got
    assert got["letter"].root == "letter" and got["letter"].form is None
    assert spelling.op12_spelling_variants(spark, docs.limit(0)).count() == 0
