"""Neighbours of pages across many ranges, against a walk over the sorted list."""

import pytest
from pyspark.sql import functions as F

from rankwell.llm import htmldiff


def _page(topic: int) -> dict:
    """Lines of a page about a topic; pages of one topic are copies."""
    return {"hashes": [topic * 10 + i for i in range(4)], "sizes": [20] * 4}


def _walk(rows):
    """(key: topics of the nearest pages of other topics before and behind it on its host), for rows in order."""
    out = {}
    for i, (key, host, _, topic) in enumerate(rows):
        sides = []
        for others in (reversed(rows[:i]), rows[i + 1 :]):
            near = next((other for other in others if other[1] != host or other[3] != topic), None)
            sides.append(near[3] if near and near[1] == host else None)
        out[key] = tuple(sides)
    return out


@pytest.mark.parametrize("span", [2, 3, 64])
@pytest.mark.parametrize("runs", [[1] * 40, [300], [5, 120, 1, 1, 90, 2], [60, 1] * 3])
def test_neighbours_over_ranges_of_copies(spark, monkeypatch, span, runs):
    """Runs of copies longer than several ranges, on two hosts, are looked over at every level."""
    monkeypatch.setattr(htmldiff, "SPAN", span)
    topics = [topic for topic, length in enumerate(runs, 1) for _ in range(length)]
    rows = [(key, f"h{key >= len(topics)}", f"/{key:05d}", topics[key % len(topics)]) for key in range(2 * len(topics))]
    table = spark.createDataFrame([(key, host, path, _page(topic)) for key, host, path, topic in rows], "key long, host string, path string, page struct<hashes:array<bigint>,sizes:array<int>>")
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        topic = lambda side: (F.col(side)["hashes"][0] / 10).cast("int").alias(side)
        got = {r.key: (r.before, r.after) for r in htmldiff.neighbour_lines(table).select("key", topic("before"), topic("after")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    assert got == _walk(rows)
