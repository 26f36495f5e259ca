"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items reads every text once.

The automaton works on words: a text is its row of word numbers (0 for a word that no item has, which leads back to
the start), a window of an item is a pattern. Word places are mapped to offsets of the original text where there are hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.llm.common import materialize

#: Consecutive words of a window; an item of fewer is one window.
WINDOW = 10
#: Windows of one automaton (a few hundred bytes each). Items beyond that go to further automata, which a task loads
#: one after another for every BUFFER bytes of text that it holds.
WINDOWS, BUFFER = 200_000, 1 << 26
#: Bytes of item texts in one broadcast; a larger benchmark is read in as many passes as it takes.
BROADCAST = 1 << 25

_PLACES = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Bytes of words in lower case, all others as a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case; null has none."""
    return (text or "").encode("utf-8", "replace").translate(_WORDS).split()


class Automaton:
    """The windows of some items: which of them end at each word of a text."""

    def __init__(self, items: list[tuple[int, str]], size: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text))
            for i in range(max(1, len(ids) - size + 1) if ids else 0):
                found.setdefault(ids[i : i + size], set()).add(item)
        self.items = [sorted(held) for held in found.values()]
        self.patterns = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for number, window in enumerate(found):
            self.patterns.add_word(window, (len(window), number))
        if found:
            self.patterns.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, set[int]]:
        """First and last word of every occurrence of a window, and the items whose windows occur."""
        ids = tuple(map(self.numbers.get, words, repeat(0)))
        hits = list(self.patterns.iter(ids)) if self.items and any(ids) else []
        last = np.array([end for end, _ in hits], np.int64)
        sizes = np.array([size for _, (size, _) in hits], np.int64)
        return last - sizes + 1, last, {item for number in {n for _, (_, n) in hits} for item in self.items[number]}


@dataclass(frozen=True)
class Items:
    """Items of one broadcast: names by number, and the texts dealt over automata of at most WINDOWS windows."""

    names: list[str | None]
    parts: list[list[tuple[int, str]]]


def _dealt(rows: list[tuple[str | None, str]]) -> Items:
    parts, room = [[]], WINDOWS
    for number, (_, text) in enumerate(rows):
        needs = max(1, len(words_of(text)) - WINDOW + 1)
        if needs > room and parts[-1]:
            parts, room = [*parts, []], WINDOWS
        parts[-1].append((number, text))
        room -= needs
    return Items([name for name, _ in rows], parts)


def runs(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Occurrences joined where they touch or overlap: first word and end of each run of hit words."""
    if not len(first):
        return []
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.append(True, first[1:] > reach[:-1] + 1)
    ends = np.append(reach[:-1][new[1:]], reach[-1])
    return [(int(a), int(b) + 1) for a, b in zip(first[new], ends, strict=True)]


_SPAN = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("begin_at", pa.int64()), ("end_at", pa.int64())])
_FOUND = "n_words long, spans array<struct<first:bigint,end:bigint,begin_at:bigint,end_at:bigint>>, items array<string>"


def _scanner(shared):
    """A pass over rows (row, text, n_words, spans, items): scans the texts for the items of one broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        loaded = Automaton(items.parts[0])
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if len(items.parts) == 1 or sum(b.nbytes for b in held) >= BUFFER:
                yield from scanned(held, items, loaded)
                held = []
        yield from scanned(held, items, loaded)

    def scanned(held: list[pa.RecordBatch], items: Items, loaded: Automaton) -> Iterator[pa.RecordBatch]:
        texts = [[t.as_py() for t in b.column(1)] for b in held]
        found: list[list[tuple[list, list, set]]] = [[([], [], set()) for _ in some] for some in texts]
        counts = [[0] * len(some) for some in texts]
        for number, part in enumerate(items.parts):
            automaton = Automaton(part) if number else loaded
            for k, some in enumerate(texts):
                for i, text in enumerate(some):
                    words = words_of(text)
                    counts[k][i] = len(words)
                    first, last, hit = automaton.scan(words)
                    if hit:
                        found[k][i][0].append(first)
                        found[k][i][1].append(last)
                        found[k][i][2].update(hit)
        for batch, some, numbers, hits in zip(held, texts, counts, found, strict=True):
            before_spans, before_items = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            spans, names = [], []
            for text, (first, last, hit), old, known in zip(some, hits, before_spans, before_items, strict=True):
                first = np.concatenate([*first, np.array([s["first"] for s in old or ()], np.int64)])
                last = np.concatenate([*last, np.array([s["end"] - 1 for s in old or ()], np.int64)])
                joined = runs(first, last)
                at = [m.span() for m in _PLACES.finditer(text)] if joined else []
                spans.append([{"first": a, "end": b, "begin_at": at[a][0], "end_at": at[b - 1][1]} for a, b in joined])
                names.append(sorted({items.names[i] for i in hit if items.names[i] is not None}.union(known or ())))
            columns = [*batch.columns[:2], pa.array(numbers, pa.int64()), pa.array(spans, pa.list_(_SPAN)), pa.array(names, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "n_words", "spans", "items"])

    return run


def _broadcasts(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[Items]:
    """The items in groups of about half of `limit` bytes: their whole size is looked at before any is collected."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull()).distinct()
    size = F.octet_length("text")
    groups = max(1, -(-2 * (rows.agg(F.sum(size)).first()[0] or 0) // limit))
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("item", "text"), F.lit(groups)))
    for number in range(groups):
        some = dealt.filter(F.col("group") == number).select("item", "text").orderBy("item", "text")
        yield _dealt([(r["item"], r["text"]) for r in some.toLocalIterator()])


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", limit: int = BROADCAST) -> DataFrame:
    """Per row of docs: id, `n_words`, `spans` (runs of hit words: first word, end word, and the offsets of both in
    the original text, in code points), `items` (distinct ids of items with occurring windows, sorted as strings).

    Null and empty texts have no words; items without words have no windows; an item without an id marks words but
    is not named; repeated items count once, items that share an id as one. Every row of docs stands alone: nothing
    is shuffled, repeated rows give repeated results, other columns are ignored, empty tables give empty results or
    none contaminated. The benchmark is broadcast in groups of at most `limit` bytes, one pass over the texts a group.
    """
    spark = docs.sparkSession
    empty = [F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<first:bigint,end:bigint,begin_at:bigint,end_at:bigint>>").alias("spans"), F.array().cast("array<string>").alias("items")]
    found = docs.select(F.col(id_col).alias("row"), F.col(text_col).alias("text"), *empty)
    kind = docs.schema[id_col].dataType.simpleString()
    for number, items in enumerate(_broadcasts(benchmark, item_id_col, item_text_col, limit)):
        if number:
            found = materialize(found)
        found = found.mapInArrow(_scanner(spark.sparkContext.broadcast(items)), f"row {kind}, text string, {_FOUND}")
    return found.select(F.col("row").alias(id_col), "n_words", "spans", "items")


def op11_aho_decontamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every whole document."""
    found = find_contamination(docs, benchmark)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["first"])
    rows = found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    return rows.withColumn("contaminated", F.col("n_hit") > 0)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_WINDOWS = "unnest(list_transform(range(1, greatest(len(w) - {n} + 1, 0) + 1), lambda i: {{'i': i, 'win': array_to_string(w[i:i + {n} - 1], ' ')}}))"
#: The same in SQL: windows of both sides as texts, met by equality.
SQL = f"""WITH d AS MATERIALIZED (SELECT doc_id, {_SPLIT} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_SPLIT} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, len(w) AS k, array_to_string(w, ' ') AS win FROM b WHERE len(w) BETWEEN 1 AND {WINDOW - 1}
  UNION SELECT item_id, {WINDOW}, x.win FROM (SELECT item_id, {_WINDOWS.format(n=WINDOW)} AS x FROM b WHERE len(w) >= {WINDOW})),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, x.i AS i, x.win AS win FROM (SELECT doc_id, k, {_WINDOWS.format(n='k')} AS x FROM d, sizes)),
hits AS (SELECT doc_id, dw.i, dw.k, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.k = bw.k),
n AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM (SELECT DISTINCT doc_id, i, k FROM hits)) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN named ON d.doc_id = named.doc_id"""
