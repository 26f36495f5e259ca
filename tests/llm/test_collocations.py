"""Collocations against the SQL of the query and plain Python, automata against counters, and odd input."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from rankwell.llm import collocations as col
from rankwell.llm import queries
from rankwell.llm import transducer as t

SMALL = "/root/testdata/sf0.001"
SCHEMA = "lang string, text string, n int, rank int, phrase string, list string"


def plain(docs, least=10, taken=50, listed=2000):
    """Every phrase with its counts by dictionaries: lang, rank, phrase, a, l, r, n, score."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    found = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    out = {}
    for (lang, *w), a in found.items():
        cuts = [(1_000_000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        if not any(100 * b >= taken * a for g, b in found.items() if len(g) == 4 and len(w) == 2 and g[0] == lang and tuple(w) in (g[1:3], g[2:4])):
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:listed], 1))


def rows(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SMALL}/documents.parquet'")
    expected = con.sql(queries.oracle_sql()["op13_phrase_collocations"])
    expected = sorted(expected.project("lang, rank, phrase, a, l, r, n, score").fetchall())
    assert rows(queries.queries()["op13_phrase_collocations"](spark, SMALL)) == expected and len(expected) > 100


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(4)
    words = ["the", "Of", "é", "日本", "a\x01", "a", "to", "x'y", "<b>"]
    text = lambda: "".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ". ", "\r", ",", "\n"]) for _ in range(draw.choice([0, 3, 40, 400])))
    body = [(draw.choice(["en", "en", "fr", None, "a\tb"]), text()) for _ in range(60)]
    return [*body, ("en", None), ("en", ""), ("zz", " . "), ("fr", body[3][1]), ("fr", body[3][1])]


@pytest.mark.parametrize("small", [False, True])
def test_random_texts(spark, texts, monkeypatch, small):
    """`small` cuts shards within texts, unites in several steps over many ranges, and asks copies of transducers."""
    if small:
        for name, value in (("SHARD", 300), ("HELD", 900), ("RANGE", 64), ("EVERY", 8), ("FAN", 3), ("ASKED", 20), ("LISTS", 3)):
            monkeypatch.setattr(col, name, value)
    docs = spark.createDataFrame([(lang, text, 1, 2, "p", "l") for lang, text in texts], SCHEMA).repartition(3)
    expected = plain(texts)
    assert rows(col.collocations(docs)) == expected and len(expected) > 50
    assert rows(col.collocations(docs, least=3, taken=90, listed=7)) == plain(texts, 3, 90, 7)


def test_windows_lose_nothing():
    draw = random.Random(6)
    for size in (5, 40, 1000):
        text = "".join(draw.choice(["a", "bb", "é"]) + draw.choice([" ", "  ", "\n"]) for _ in range(500)).encode() + b"c" * 60
        got, expected = Counter(), Counter()
        for part, ahead in col.windows(text, size):
            got.update(spelled(col.count_grams(part, ahead)))
        for piece in text.decode().split("\n"):
            w = piece.split()
            expected.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        assert got == expected


def spelled(grams):
    return {tuple(w for w in grams.spelled(k, i) if w): int(c) for k, level in enumerate(grams.levels) for i, c in enumerate(level.count) if c}


def grams_of(counts):
    words = sorted({w for g in counts for w in g}, key=str.encode)
    full = {g[:k]: 0 for g in counts for k in range(1, len(g))} | dict(counts)
    levels, above = [], {(): 0}
    for k in (1, 2, 3):
        some = sorted((g for g in full if len(g) == k), key=lambda g: [words.index(w) for w in g])
        levels.append(t.Level(*(np.array(x, np.int64) for x in ([above[g[:-1]] for g in some], [words.index(g[-1]) for g in some], [full[g] for g in some]))))
        above = {g: i for i, g in enumerate(some)}
    return t.Grams(pa.array(words, pa.large_string()), tuple(levels))


def test_automata_against_counters():
    draw = random.Random(1)
    some = lambda n, letters: Counter(tuple(draw.choice(letters) for _ in range(draw.choice([1, 2, 3]))) for _ in range(n))
    for _ in range(40):
        a, b = some(draw.choice([1, 3, 50, 300]), "abcdefgé"), some(draw.choice([1, 30, 300]), "abxyzé")
        automaton = t.Transducer.from_bytes(t.build(grams_of(a)).to_bytes())
        assert spelled(automaton.grams()) == dict(a)
        both = t.union([grams_of(a), grams_of(b)])
        assert spelled(both) == dict(a + b) and spelled(both.pruned(3)) == {g: n for g, n in (a + b).items() if n >= 3}
        cuts = sorted({(*g, "", "")[:3] for g in draw.sample(sorted(a), min(4, len(a)))})
        assert sum((Counter(spelled(s)) for _, s in both.sliced(cuts)), Counter()) == a + b
        asked = grams_of(some(40, "abcxq"))
        for k, found in enumerate(t.build(both).compose(asked)):
            assert [(a + b).get(tuple(w for w in asked.spelled(k, i) if w), 0) for i in range(len(asked.levels[k]))] == found.tolist()


def test_equal_states_are_one():
    counts = {("a",): 2, ("b",): 2, ("a", "x"): 1, ("b", "x"): 1, ("a", "x", "z"): 1, ("b", "x", "z"): 1}
    assert len(t.build(grams_of(counts)).begin) - 1 == 4


def test_exact_scores_beyond_64_bits(spark):
    frame = spark.createDataFrame([(10**13, 3 * 10**13, 2 * 10**13 + 1)], "a long, l long, r long")
    assert frame.select(col._score(frame.a, frame.l, frame.r)).first()[0] == 10**6 * 10**26 // (3 * 10**13 * (2 * 10**13 + 1))


def test_empty_and_long(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert col.op13_phrase_collocations(spark, none).count() == 0
    docs = spark.createDataFrame([(None, "a b c " * 400_000, 1, 1, "", "")], SCHEMA)
    got = rows(col.collocations(docs))
    assert [r[2] for r in got] == ["a b c", "b c a", "c a b"] and got[0][3:7] == (400_000, 400_000, 400_000, 1_200_000)
