"""Spelling variant grouping: words one edit apart, found by a bidirectional FM-index, lead to their common form.

Two words are one edit apart only if one begins with the first half of the other or ends with its second half. So
words meet by those halves: each is indexed under the halves that words of its length, one less and one more can have,
and asks under its own two. What meets is dealt over blocks, and each block is one index.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.llm.common import materialize
from rankwell.llm.fmindex import Index

#: Least code points and occurrences of a word, and how many times as frequent its form is.
LETTERS, OCCURRENCES, TIMES = 6, 5, 5
#: One run in so many loses a letter.
SPOILED = 199
#: Words of a block, about; words that one half brings together beyond that are dealt over blocks of their own.
BLOCK = 16_384
#: Distinct words that a task counts before it hands them on, and characters of a text that are listed at once.
HELD, LISTED = 200_000, 1 << 20
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def runs(text: str) -> Counter[str]:
    """Maximal runs of letters with A-Z in lower case, counted."""
    found = Counter(_RUN.findall(text)) if len(text) <= LISTED else Counter(m.group() for m in _RUN.finditer(text))
    out: Counter[str] = Counter()
    for run, n in found.items():
        out[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    return out


def spoiled(doc_id: object, run: str) -> str:
    """The run, without one letter where the checksum of id and run says so; a null id reads as empty."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run if h % SPOILED else run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """Distinct words of all texts with their occurrences: word, n. Null and empty texts have none; repeated rows count
    again. Tasks add up what they hold before it is shuffled, so a frequent word is one row a task."""
    def batch(held: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for some in batches:
            for doc_id, text in zip(some.column(0).to_pylist(), some.column(1), strict=True):
                for found, n in runs(text.as_py() or "").items():
                    word = spoiled(doc_id, found)
                    if len(word) >= letters:
                        held[word] += n
                if len(held) > HELD:
                    yield batch(held)
                    held = Counter()
        yield batch(held)

    parts = docs.select(id_col, text_col).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def _halves(word: Column, sizes: Column) -> Column:
    """Sides and halves that this word would share with words of the given sizes."""
    half = lambda side, key: F.struct(F.lit(side).alias("side"), key.alias("key"))
    first = F.transform(sizes, lambda m: half("p", F.left(word, F.floor(m / 2).cast("int"))))
    second = F.transform(sizes, lambda m: half("s", F.right(word, F.ceil(m / 2).cast("int"))))
    return F.array_distinct(F.concat(first, second))


def _search_block(key: tuple, words: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """How many words of the block are near each query, and the most frequent of them, the first of equal ones."""
    made = pd.DataFrame({"word": pd.Series(dtype=str), "n_near": pd.Series(dtype="int64"), "form": pd.Series(dtype=str), "form_n": pd.Series(dtype="int64")})
    if words.empty or queries.empty:
        return made
    words = words.drop_duplicates("word").sort_values("word")
    asked = queries["word"].drop_duplicates().tolist()
    counts = words["n"].to_numpy()
    query, near = Index(words["word"].tolist()).near(asked, key[0])
    if not len(query):
        return made
    order = np.lexsort((near, -counts[near], query))
    query, near = query[order], near[order]
    at = np.flatnonzero(np.append(True, np.diff(query) != 0))
    best = near[at]
    return pd.DataFrame({"word": [asked[q] for q in query[at]], "n_near": np.diff(np.append(at, len(query))), "form": words["word"].to_numpy()[best], "form_n": counts[best]})


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per word (word, n; distinct) with near words: how many there are (`n_near`), the most frequent of them (`form`,
    the first in code-point order of equal ones) and its count (`form_n`). Words of one letter or none have none.

    Every near word is met once: in the block of the half that it shares with the asking word, the first half before
    the second. A half that more than `block` words share is dealt over blocks of its own, and those who ask under it
    ask in all of them. Counts are added up where they are found, no pair of words is shuffled.
    """
    words = words.filter(F.char_length("word") > 1)
    size = F.char_length("word")
    placed = words.select("word", "n", F.explode(_halves(F.col("word"), F.array(F.greatest(size - 1, F.lit(2)), size, size + 1))).alias("h")).select("word", "n", "h.side", "h.key")
    asking = words.select("word", F.explode(_halves(F.col("word"), F.array(size))).alias("h")).select("word", "h.side", "h.key")
    blocks = max(1, -(-4 * words.count() // block))
    shared = placed.groupBy("side", "key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > block)
    shared = shared.select("side", "key", F.ceil(F.col("c") / (block // 2)).cast("int").alias("salts"))

    def dealt(rows: DataFrame, salt: Column) -> DataFrame:
        """side, block, own half (of a crowded one, else empty) and salt: what stands in one task."""
        salted = rows.join(shared, ["side", "key"], "left").withColumn("salt", salt)
        crowded = F.col("salts").isNotNull()
        number = F.when(crowded, F.lit(-1)).otherwise(F.pmod(F.xxhash64("side", "key"), F.lit(blocks)).cast("int"))
        return salted.select("side", number.alias("block"), F.when(crowded, F.col("key")).otherwise("").alias("own"), "salt", *[F.col(c).alias(c) for c in ("word", "n") if c in rows.columns])

    salts = F.coalesce("salts", F.lit(1))
    left = dealt(placed, F.pmod(F.xxhash64(F.lit(1), "word"), salts).cast("int"))
    right = dealt(asking, F.explode(F.sequence(F.lit(0), salts - 1)))
    keys = ("side", "block", "own", "salt")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search_block, "word string, n_near long, form string, form_n long")
    first = F.min_by(F.struct("form", "form_n"), F.struct(-F.col("form_n"), F.col("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select("word", "n_near", "best.form", "best.form_n")


def variants(words: DataFrame, times: int = TIMES, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct words with counts (word, n); see `near_words`.

    `form` is the most frequent near word if it occurs at least `times` as often, else null; `root` is where forms
    lead to in the end. Counts grow by `times` at each step, so the way is short; it is halved in each round.
    """
    words = materialize(words.select("word", "n"))
    near = near_words(words, block)
    frequent = F.col("form_n") >= times * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(frequent, F.col("form")).alias("form"), F.when(frequent, F.col("form_n")).alias("form_n")
    )
    made = materialize(joined)
    way = made.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("at"))
    while True:
        onward = way.select(F.col("word").alias("at"), F.col("at").alias("next"))
        moved = materialize(way.join(onward, "at", "left").select("word", F.coalesce("next", "at").alias("at"), F.col("next").isNotNull().alias("moved")))
        way = moved.select("word", "at")
        if moved.filter("moved").isEmpty():
            break
    return made.join(way, "word", "left").select("word", "form", F.coalesce("at", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of six letters and five occurrences in the documents."""
    return variants(word_counts(docs))
