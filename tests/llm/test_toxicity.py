"""Parts of the toxicity scores against plain counts: features, word counts without the text itself, calibration."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from rankwell.llm import toxicity
from rankwell.llm.common import held_out

FOLDER = "/root/testdata/sf0.01"
WORDS = ["you", "Your", "idiot", "IDIOT!", "tree", "river", "NOISE", "st0ne", "1d1ot", "why?", "so!!", "gr@ss", "2024", "tú", "a", "grumble", "Grumbles", "...", "#x"]
COUNTS = {"grumble": (8, 1), "grumb*": (9, 1), "river": (1, 40), "stone": (6, 0), "tree": (3, 3)}


def _plain_features(text, lexicon):
    """The features that need no look at a disguise, each counted over all words or characters again."""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text.encode()))
    bare = [w.strip(toxicity.STRIP) for w in words]
    letters = sum(ch.isascii() and ch.isalpha() for ch in text) or 1
    you = [i for i, w in enumerate(bare) if w.lower() in toxicity.SECOND]
    return {
        "log_words": math.log1p(len(words)), "you_rate": len(you) / n, "capital_rate": sum("A" <= ch <= "Z" for ch in text) / letters,
        "shouted_rate": sum(len(w) > 2 and w.isupper() for w in bare) / n, "exclamation_rate": text.count("!") / size, "question_rate": text.count("?") / size, "digit_rate": sum(ch in "0123456789" for ch in text) / size,
        "symbol_rate": sum(33 <= ord(ch) < 127 and not ch.isalnum() and ch not in ".,;:!?'\"-" for ch in text) / size,
    }


def _text(draw, length):
    return " ".join(draw.choice(WORDS) for _ in range(length))


@pytest.mark.parametrize("length", [0, 1, 7, 60, 4000])
def test_features_against_counts(length):
    lexicon = toxicity.Lexicon(10, 50, COUNTS)
    draw = random.Random(length)
    for _ in range(3 if length > 1000 else 60):
        text = _text(draw, length)
        got = dict(zip(toxicity.NAMES, toxicity.features(text, toxicity._Words(COUNTS), lexicon), strict=True))
        for name, value in _plain_features(text, lexicon).items():
            assert got[name] == pytest.approx(value), (name, text)


def test_hits_near_a_second_person_word():
    """A hit counts as near if any second-person word lies within NEAR words of it, on either side."""
    lexicon, draw = toxicity.Lexicon(10, 50, {}), random.Random(3)
    for _ in range(300):
        words = [draw.choice(["you", "idiot", "tree", "river", "stone"]) if draw.random() < 0.2 else "tree" for _ in range(draw.randrange(1, 80))]
        hits, you = ([i for i, w in enumerate(words) if w == wanted] for wanted in ("idiot", "you"))
        near = sum(any(abs(i - k) <= toxicity.NEAR for k in you) for i in hits)
        got = dict(zip(toxicity.NAMES, toxicity.features(" ".join(words), toxicity._Words({}), lexicon), strict=True))
        assert got["near_you_rate"] == pytest.approx(near / len(words)) and got["hit_rate"] == pytest.approx(len(hits) / len(words))
        assert got["log_distinct_hits"] == pytest.approx(math.log1p(bool(hits)))


@pytest.mark.parametrize("label", [0, 1])
def test_a_text_is_left_out_of_the_word_counts(label):
    """The weight with a label equals that of a lexicon counted without a text of this label."""
    for a in range(0, 12):
        for b in range(0, 12):
            if (a if label else b) == 0:
                continue
            whole = toxicity.Lexicon(20, 60, {"w": (a, b)})
            without = toxicity.Lexicon(20 - label, 60 - (1 - label), {"w": (a - label, b - (1 - label))})
            assert whole.weight("w", label) == pytest.approx(without.weight("w"))


def _isotonic(x, y):
    """The rising fit of y over x by its closed form: the largest over the left ends of the least mean to the right."""
    points = np.unique(x)
    total = np.array([y[x == p].sum() for p in points])
    count = np.array([(x == p).sum() for p in points])
    mean = lambda a, b: total[a : b + 1].sum() / count[a : b + 1].sum()
    n = len(points)
    return {p: max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i, p in enumerate(points)}


def test_calibration_against_the_closed_form(spark):
    """The calibration is the isotonic fit over a quarter of the labelled rows, none held out, none the trees saw."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    known = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    rows = docs.groupBy("doc_id").agg(F.min("text").alias("text")).join(known, "doc_id").filter(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0)
    made = rows.select("y", array_to_vector(toxicity._feature_column(F.col("text"), model.lexicon, F.col("y"))).alias("__f"))
    scored = model.trees.transform(made).select("y", vector_to_array("__prob")[1].alias("p")).toPandas()
    expected = _isotonic(scored["p"].to_numpy(), scored["y"].to_numpy().astype(float))
    points = spark.createDataFrame([(float(p),) for p in expected], "p double").withColumn("__v", array_to_vector(F.array("p")))
    got = {r["p"]: r["__iso"] for r in model.scale.transform(points).collect()}
    assert len(expected) > 3 and got == pytest.approx(expected, abs=1e-9)
    final = model.score(docs.select("doc_id", "text")).select("score").toPandas()["score"]
    assert final.between(0, 1).all() and len(final) == docs.count()
