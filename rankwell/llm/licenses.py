"""License scans: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment."""

from __future__ import annotations

import functools
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.llm.license_rules import RULES

#: Base phrases, as words that stand next to each other, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Turns a text in UTF-8 into lower case with every byte that is not part of a word as a space. Bytes above 127 belong to words.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
#: How much one detection of each priority counts towards the score.
TRUST = {1: 0.4, 2: 0.7, 3: 0.9}


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    priority: int
    pattern: re.Pattern[str]


@functools.cache
def rules() -> dict[str, list[Rule]]:
    """The rules by keyword; every pattern starts and ends with whole words."""
    found: dict[str, list[Rule]] = {}
    order = 0
    for line in RULES.strip().splitlines():
        if head := re.fullmatch(r"\[(\S+) ([123]) (.+)\]", line):
            label, priority, keyword = head[1], int(head[2]), head[3]
            continue
        found.setdefault(keyword, []).append(Rule(order, label, priority, re.compile(rf"(?<= )(?:{line})(?= )")))
        order += 1
    return found


@dataclass(frozen=True)
class Detection:
    """A span of words [first, last) that a rule matched."""

    first: int
    last: int
    label: str
    priority: int
    order: int


def scan(text: str | None) -> tuple[int, list[Detection], list[tuple[int, str]]]:
    """Words in a whole text, surviving detections in order, and all places (start word, label) of base phrases."""
    spaced = b" " + b" ".join((text or "").encode("utf-8", "replace").translate(_WORDS).split()) + b" "
    n_words = max(0, spaced.count(b" ") - 1) if len(spaced) > 2 else 0
    base = [(at, label) for phrase, label in BASE.items() for at in _places(spaced, b" " + phrase.encode() + b" ")]
    present = [found for keyword, found in rules().items() if keyword.encode() in spaced]
    if not present and not base:
        return n_words, [], []
    plain = spaced.decode()
    gaps = [i for i, c in enumerate(plain) if c == " "]
    raw = []
    for group in present:
        for rule in group:
            for m in rule.pattern.finditer(plain):
                raw.append(Detection(bisect_right(gaps, m.start()) - 1, bisect_right(gaps, m.end()) - 1, rule.label, rule.priority, rule.order))
    return n_words, resolve(raw), _numbered(spaced, sorted(base))


def _numbered(spaced: bytes, base: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """Ascending places as word numbers, each counted on from the one before."""
    out, words, before = [], 0, 0
    for at, label in base:
        words += spaced.count(b" ", before, at)
        before = at
        out.append((words, label))
    return out


def _places(spaced: bytes, phrase: bytes) -> Iterator[int]:
    at = spaced.find(phrase)
    while at >= 0:
        yield at
        at = spaced.find(phrase, at + 1)


def resolve(raw: list[Detection]) -> list[Detection]:
    """Detections that stand: longer spans first, then higher priority, then the earlier rule.

    A detection within a standing one is dropped, unless its priority is higher; one that overlaps a standing one
    in part is dropped if its priority is lower. The order of equal spans is that of the rules.
    """
    standing: list[Detection] = []
    covering: dict[int, list[Detection]] = {}  # by word
    for d in sorted(raw, key=lambda d: (-(d.last - d.first), -d.priority, d.order, d.first)):
        near = {s for word in range(d.first, d.last) for s in covering.get(word, ())}
        if any((s.first <= d.first and d.last <= s.last and d.priority <= s.priority) or d.priority < s.priority for s in near):
            continue
        standing.append(d)
        for word in range(d.first, d.last):
            covering.setdefault(word, []).append(d)
    return sorted(standing, key=lambda d: (d.first, d.last, d.order))


def scan_documents(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, `n_words`, `detections` (array of first word, end word, label, priority), `base` (array of start
    word, label).

    Null and empty texts have no words and no detections. Every row stands alone: nothing is shuffled, repeated
    rows give repeated results, other columns are ignored, an empty table gives an empty one.
    """
    spans = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("priority", pa.int32())]))
    bases = pa.list_(pa.struct([("first", pa.int64()), ("label", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [scan(t) for t in batch.column(1).to_pylist()]
            found = [[{"first": d.first, "last": d.last, "label": d.label, "priority": d.priority} for d in ds] for _, ds, _ in made]
            base = [[{"first": at, "label": label} for at, label in places] for _, _, places in made]
            columns = [batch.column(0), pa.array([n for n, _, _ in made], pa.int64()), pa.array(found, spans), pa.array(base, bases)]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "detections", "base"])

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, detections array<struct<first:bigint,last:bigint,label:string,priority:int>>, base array<struct<first:bigint,label:string>>"
    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def op1_license_scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Licences in every whole document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the chance that one detection at least is right, if each were right by itself with the trust of
    its priority (a base phrase: 0.7).
    """
    made = scan_documents(docs)
    label = lambda x: x["label"]
    starts = F.transform("base", lambda x: x["first"])
    doubt = F.aggregate("detections", F.lit(1.0), lambda acc, x: acc * F.when(x["priority"] == 3, 1 - TRUST[3]).when(x["priority"] == 2, 1 - TRUST[2]).otherwise(1 - TRUST[1]))
    base_doubt = F.when(F.size("base") > 0, 1 - TRUST[2]).otherwise(1.0)
    joined = lambda column: F.array_join(F.array_sort(F.array_distinct(column)), ",")
    return made.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(F.transform("base", label)).alias("base_labels"), joined(F.concat(F.transform("base", label), F.transform("detections", label))).alias("labels"), (1 - doubt * base_doubt).alias("score"),
    )
