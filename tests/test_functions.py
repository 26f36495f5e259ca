"""Expressions, coercions and text functions on tiny frames."""

import random
import re
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from rankwell.functions import coerce, text, wikitext
from rankwell.functions import exprs as x


def values(spark, rows, schema, **columns):
    made = spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()])
    return [tuple(r) for r in made.collect()]


def test_lossy_values_of_json_fields(spark):
    rows = [(v,) for v in ("3", "3.7", '"12"', '" 5 "', '"x"', "true", "[1]", '{"a":1}', "null", '"oui"', '"  "')]
    field = F.parse_json("j")
    got = values(spark, rows, "j string", i=coerce.lossy_int(field), b=coerce.lossy_bool(field), s=coerce.lossy_str_variant(field))
    assert [g[0] for g in got] == [3, 3, 12, 5, None, None, None, None, None, None, None]
    assert [g[1] for g in got] == [None] * 5 + [True] + [None] * 5
    assert [g[2] for g in got] == [None, None, "12", " 5 ", "x", None, None, None, None, "oui", None]


def test_dates_amounts_counts_and_instants(spark):
    rows = [("2024-03-17", "1,250,000", "24", "2024-01-01T00:00:00Z"), ("2024-03-??", "{{:x/prizepool}}", "n", "soon"), ("2024-03", "$8,763.33", " 5 ", None), ("2024-02-30", "", "", "2024"), (None, None, None, "")]
    got = values(spark, rows, "d string, a string, n string, t string", d=coerce.strict_iso_date(F.col("d")), a=coerce.amount(F.col("a")), n=coerce.count_value(F.col("n")), t=F.unix_seconds(coerce.iso_timestamp(F.col("t"))))
    assert got == [(date(2024, 3, 17), 1250000.0, 24, 1704067200), (None, None, None, None), (None, 8763.33, 5, None), (None, None, None, None), (None, None, None, None)]


def test_epoch_and_payload(spark):
    got = values(spark, [(1,), (0,), (-5,), (None,)], "s long", t=F.unix_seconds(coerce.epoch_to_ts(F.col("s"))))
    assert [g[0] for g in got] == [1, None, None, None]
    row = values(spark, [({"b": "1", "a": "2"},)], "m map<string,string>", p=coerce.keep_payload(F.col("m"), sort_keys=True))
    assert row == [('{"a":"2","b":"1"}',)]


def test_keys_and_blanks(spark):
    got = values(spark, [("  A ", 1), ("  ", 2), (None, 3)], "s string, n int", b=x.blank_to_null(F.col("s")), f=x.fold_key(F.col("s")), k=x.readable_key("s", "n"))
    assert got == [("A", "a", "  A :1"), (None, None, "  :2"), (None, None, None)]


def test_sides_and_winners_are_three_valued(spark):
    rows = [(2, 1, True), (1, 2, False), (1, 1, None), (None, 2, True)]
    got = values(spark, rows, "a int, b int, f boolean", side=x.side_from_flag(F.col("f")), won=x.winner_by_score(F.col("a"), F.col("b")), gap=x.score_gap(F.col("a"), F.col("b")))
    assert got == [(1, 1, 1), (2, 2, 1), (None, None, 0), (1, None, None)]
    got = values(spark, [("x", "x", "y"), ("y", "x", "y"), ("z", "x", "y"), (None, "x", "y")], "t string, a string, b string", s=x.side_of_team(F.col("t"), F.col("a"), F.col("b")))
    assert got == [(1,), (2,), (None,), (None,)]
    pick = x.pick_attributes(F.col("a"), F.col("t"), F.lit("x"), F.lit("y"))
    got = values(spark, [("pick", "y"), ("decider", None), (None, None)], "a string, t string", **pick)
    assert got == [(False, "y", 2), (True, None, None), (None, None, None)]


def test_date_conflicts(spark):
    d = lambda n: date(2024, 1, n)
    rows = [(d(1), d(3)), (d(3), d(1)), (None, d(2)), (d(2), None)]
    got = values(spark, rows, "s date, e date", e=x.consistent_end(F.col("s"), F.col("e")), c=x.has_date_conflict(F.col("s"), F.col("e")), n=x.duration_days(F.col("s"), F.col("e")))
    assert got == [(d(3), False, 3), (None, True, None), (d(2), False, None), (None, False, None)]


def test_tier_ranks(spark):
    got = values(spark, [(t,) for t in ("S-Tier", "a", "3", "c-tier", "d", "", None)], "t string", r=x.tier_rank_case(F.col("t")))
    assert [g[0] for g in got] == [1, 2, 3, 4, 5, 5, 5]


def test_clock_fraction_and_positions(spark):
    won, played = x.fraction_parts(F.col("f"))
    got = values(spark, [("63:00", "5/8", [7]), ("63", "5", []), (None, None, None)], "c string, f string, a array<int>", c=x.clock_to_seconds(F.col("c")), w=won, p=played, one=x.at(F.col("a"), 0), two=x.at(F.col("a"), 1), z=x.safe_ratio(F.lit(3), F.lit(0)))
    assert got == [(3780, 5, 8, 7, None, None), (None, 5, None, None, None, None), (None, None, None, None, None, None)]


@pytest.mark.parametrize(("raw", "shown"), [
    ("[//maps.test/9?q=1 The  Old Mill]", "The Old Mill"), ("[http://a.test]", ""), ("[[Harbour]] hall", "Harbour hall"), ("[[Harbour|by the sea]]", "by the sea"), ("[[a|b|c]]", "[[a|b|c]]"), ("one<BR />two<br>three", "one two three"),
    ("'''''both''''' don't", "both don't"), ("{{icon|{{size|9}}}} North", "North"), ("x <!-- {{ --> y", "x y"), ("{{a {b} c}}", "{{a {b} c}}"), ("{{{a}}}", "{}"), ("2 < 3 <b class=x>bold</b>", "2 < 3 bold"), ("<!-- open", "<!-- open"), ("[[no end", "[[no end"), ("  \n", ""), ("", ""), (None, None),
])
def test_markup(spark, raw, shown):
    assert values(spark, [(raw,)], "t string", t=wikitext.strip_markup(F.col("t"))) == [(shown,)]


def test_markup_equals_repeated_removal():
    """Templates by removing innermost ones until none is left, on random braces and letters."""
    draw = random.Random(7)
    for _ in range(3000):
        text = "".join(draw.choice(["{", "{{", "}", "}}", "a", "|"]) for _ in range(draw.randrange(16)))
        rest, before = text, None
        while rest != before:
            before, rest = rest, re.sub(r"[{]{2}([^{}]*)[}]{2}", "", rest)
        assert wikitext.readable(text) == rest


@pytest.mark.parametrize("text", ["{{" * 100_000, "{{" * 100_000 + "}}" * 100_000, "[[a|b|" * 100_000 + "]]", "[//x" * 100_000, "<!--" * 100_000, "<b" * 100_000, "<br " * 100_000])
def test_markup_is_linear(text):
    began = time.time()
    wikitext.readable(text)
    assert time.time() - began < 4


def test_comments_numbers_and_spaces(spark):
    assert values(spark, [("a <!-- x\ny --> b <!-- open\n z",)], "t string", t=text.strip_comments(F.col("t"))) == [("a  b ",)]
    assert values(spark, [("12 then 3.5 and 99999999999999999999",)], "t string", n=F.size(text.numbers_in(F.col("t"))), i=text.ints_in(F.col("t")), f=text.first_int(F.col("t"))) == [(3, [12, 3, 5, None], 12)]
    assert values(spark, [(" 13\xa0‑\n 5 ",), (" \xa0 ",)], "t string", t=text.clean_text(F.col("t"))) == [("13 - 5",), (None,)]
    assert values(spark, [('<a href="x" src="y" width="3">',)], "t string", t=text.slim_html(F.col("t"))) == [('<a href="x">',)]
    assert values(spark, [('{"a":1}',), ("{",), (None,)], "t string", t=coerce.json_readable(F.col("t"))) == [(True,), (False,), (None,)]
