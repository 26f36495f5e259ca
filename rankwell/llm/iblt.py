"""Document fingerprints by invertible Bloom lookup sketches, with DataFrame functions only.

A text is the multiset of its paragraphs (lines). Each paragraph's digest falls into three cells, one in each third
of the sketch; a cell adds up how many digests it got, the sums of their upper and lower halves, and the sum of their
checks. Sums of 28 bits at most hold 2^35 paragraphs, more than a text can have. The sketch of one
version less that of another is the sketch of what differs; a cell with one digest left (once or several times)
gives it up, it is taken from its other cells, and so on until nothing is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankwell.llm.common import materialize, whole_text

#: Cells of the stored sketch, and of the sketches tried in turn where it is too small.
CELLS = 24
LARGER = (24, 48, 96, 192)
#: Differing paragraphs that one retried sketch is expected to hold; the digests are dealt over as many as it takes.
LOAD = 8
#: Bits of the lower half of a digest, and of the upper one.
HALF = 22
#: Steps of peeling; each works on one third of the cells, in turn.
STEPS = 18
#: Bytes of text in one of the ranges over which texts meet the next ones, on average: the first up to MANY ranges
#: (as many at least as FEW), beyond that more, up to the second.
RANGE_BYTES, LARGE_BYTES = 1 << 23, 1 << 28
FEW, MANY = 32, 4096
#: Keys drawn for each range.
KEYS = 8
#: Stands for a null id in the order of ids.
_NO_ID = -(1 << 63)
_FOUND = "array<struct<x:bigint,n:bigint>>"


def digests(text: Column) -> Column:
    """44-bit digests of the paragraphs of a text, in order, repeats included."""
    return F.transform(F.split(text, "\n"), lambda line: F.shiftrightunsigned(F.xxhash64(line), 20))


def _check(digest: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(digest), 36)


def _slot(digest: Column, third: Column, cells: Column) -> Column:
    """The cell of a digest within one third of the sketch."""
    return (F.call_function("shiftright", digest, third * 12) % F.call_function("div", cells, F.lit(3))).cast("int")


def _upper(digest: Column) -> Column:
    return F.shiftright(digest, HALF)


def _lower(digest: Column) -> Column:
    return digest.bitwiseAND(F.lit((1 << HALF) - 1))


def _cell(n: Column, k: Column, m: Column, h: Column) -> Column:
    return F.struct(n.alias("n"), k.alias("k"), m.alias("m"), h.alias("h"))


def _moved(cell: Column, digest: Column, n: Column) -> Column:
    """A cell with n more of a digest in it."""
    return _cell(cell["n"] + n, cell["k"] + n * _upper(digest), cell["m"] + n * _lower(digest), cell["h"] + n * _check(digest))


def sketch(of: Column, cells: Column) -> Column:
    """The cells (n, k, m, h) of an array of digests, third by third."""
    zero, one = _cell(*[F.lit(0).cast("long")] * 4), F.lit(1).cast("long")

    def third(t: Column) -> Column:
        places = F.sequence(F.lit(0), (F.call_function("div", cells, F.lit(3)) - 1).cast("int"))
        return F.transform(places, lambda i: F.aggregate(F.filter(of, lambda x: _slot(x, t, cells) == i), zero, lambda a, x: _moved(a, x, one)))

    return F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), third)


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def subtract(a: Column, b: Column) -> Column:
    """The sketch of what differs."""
    return F.zip_with(a, b, lambda x, y: F.zip_with(x, y, lambda p, q: _cell(*[p[name] - q[name] for name in "nkmh"])))


def peel(difference: Column, cells: Column) -> Column:
    """The digests that differ, each with how many more the first version has (x, n), from the sketch of the
    difference; null if digests are left that do not come free.
    """
    def free(third: Column, t: Column) -> Column:
        share = lambda c, name: F.when(c[name] % F.nullif(c["n"], F.lit(0)) == 0, F.call_function("div", c[name], F.nullif(c["n"], F.lit(0)))).otherwise(-1)
        whole = lambda c: _let(F.struct(share(c, "k").alias("k"), share(c, "m").alias("m")), lambda s: F.when((s["k"] >= 0) & s["m"].between(0, (1 << HALF) - 1), F.shiftleft(s["k"], HALF) + s["m"]).otherwise(-1))
        keyed = F.transform(third, lambda c, i: F.when(c["n"] != 0, F.struct(c["n"].alias("n"), whole(c).alias("x"), c["h"].alias("h"), i.alias("i"))))
        return F.filter(keyed, lambda p: p.isNotNull() & (p["x"] >= 0) & (_check(p["x"]) * p["n"] == p["h"]) & (_slot(p["x"], t, cells) == p["i"]))

    def step(state: Column, r: Column) -> Column:
        def take(pure: Column) -> Column:
            less = lambda a, e: _moved(a, e["x"], -e["n"])
            gone = lambda u: F.transform(pure, lambda p: F.struct(_slot(p["x"], u, cells).alias("s"), p["n"].alias("n"), p["x"].alias("x")))
            left = F.transform(state["cells"], lambda third, u: _let(gone(u), lambda out: F.transform(third, lambda c, i: F.aggregate(F.filter(out, lambda e: e["s"] == i), c, less))))
            found = F.concat(state["found"], F.transform(pure, lambda p: F.struct(p["x"].alias("x"), p["n"].alias("n"))))
            idle = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), (state["idle"] + 1).alias("idle"))
            return F.when(F.size(pure) > 0, F.struct(left.alias("cells"), found.alias("found"), F.lit(0).alias("idle"))).otherwise(idle)

        # three steps in a row without a free cell: nothing more comes
        return F.when(state["idle"] < 3, _let(free(F.get(state["cells"], r % 3), r % 3), take)).otherwise(state)

    start = F.struct(difference.alias("cells"), F.array().cast(_FOUND).alias("found"), F.lit(0).alias("idle"))
    end = F.aggregate(F.sequence(F.lit(0), F.lit(STEPS - 1)), start, step)
    clean = lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["m"] == 0) & (c["h"] == 0)
    return _let(end, lambda s: F.when(F.forall(s["cells"], lambda third: F.forall(third, clean)), s["found"]))


def _result(found: Column, failed: Column, direct: Column) -> Column:
    return F.struct(found.cast(_FOUND).alias("found"), failed.cast("int").alias("failed"), direct.cast("int").alias("direct"))


def _counted(a: Column, b: Column) -> Column:
    """The differing digests of two small arrays, counted one by one."""
    count = lambda of, x: F.size(F.filter(of, lambda e: e == x)).cast("long")
    each = F.transform(F.array_distinct(F.concat(a, b)), lambda x: F.struct(x.alias("x"), (count(a, x) - count(b, x)).alias("n")))
    return F.filter(each, lambda e: e["n"] != 0)


def _grouped(a: Column, b: Column, parts: Column) -> Column:
    """The digests of both arrays dealt over `parts`: arrays of (part, x, mine), by one sort and cuts between parts."""
    deal = lambda of, mine: F.transform(of, lambda x: F.struct(F.pmod(F.xxhash64(x, F.lit(7)), parts).alias("part"), x.alias("x"), F.lit(mine).alias("mine")))

    def cut(entries: Column) -> Column:
        begins = lambda i: (i == 0) | (F.get(entries, i)["part"] != F.get(entries, i - 1)["part"])
        starts = F.filter(F.transform(entries, lambda _, i: F.when(begins(i), i)), lambda i: i.isNotNull())
        return _let(starts, lambda at: F.transform(at, lambda i, j: F.slice(entries, i + 1, F.coalesce(F.get(at, j + 1), F.size(entries)) - i)))

    return _let(F.array_sort(F.concat(deal(a, True), deal(b, False))), cut)


def differences(a: Column, b: Column, stored_a: Column | None = None, stored_b: Column | None = None) -> Column:
    """What two arrays of digests do not share: struct of `found` (digest x, n more in a than in b), `failed`, the
    sketches that did not peel, and `direct`, the parts that did not peel at any size.

    The stored sketches are subtracted and peeled first. On failure the digests of both are dealt over enough
    sketches for LOAD paragraphs each, and each of those is retried larger as long as it fails; a part that fails at
    every size is counted digest by digest. The work grows with the number of paragraphs (and the log of it).
    """
    stored = lambda given, of: sketch(of, F.lit(CELLS)) if given is None else given
    # what lambdas use again and again is computed once
    return _let(F.struct(a.alias("a"), b.alias("b")), lambda v: _differences(v["a"], v["b"], stored(stored_a, v["a"]), stored(stored_b, v["b"])))


def _differences(a: Column, b: Column, stored_a: Column, stored_b: Column) -> Column:
    def tried(x: Column, y: Column) -> Column:
        once = lambda m: peel(subtract(sketch(x, m), sketch(y, m)), m)
        start = _result(F.lit(None), F.lit(0), F.lit(0))
        again = lambda s, m: _let(once(m), lambda f: _result(f, s["failed"] + f.isNull().cast("int"), F.lit(0)))
        end = F.aggregate(F.array(*map(F.lit, LARGER)), start, lambda s, m: F.when(s["found"].isNull(), again(s, m)).otherwise(s))
        return _let(end, lambda s: F.when(s["found"].isNotNull(), s).otherwise(_result(_counted(x, y), s["failed"], F.lit(1))))

    def dealt(parts: Column) -> Column:
        side = lambda g, mine: F.transform(F.filter(g, lambda e: e["mine"] == F.lit(mine)), lambda e: e["x"])
        groups = _grouped(a, b, parts)
        each = F.transform(groups, lambda g: _let(F.struct(side(g, True).alias("x"), side(g, False).alias("y")), lambda p: tried(p["x"], p["y"])))
        total = lambda of, name: F.aggregate(of, F.lit(0), lambda s, r: s + r[name])
        return _let(each, lambda r: _result(F.flatten(F.transform(r, lambda x: x["found"])), total(r, "failed") + 1, total(r, "direct")))

    parts = F.ceil((F.size(a) + F.size(b)) / LOAD).cast("long")
    first = peel(subtract(stored_a, stored_b), F.lit(CELLS))
    return _let(first, lambda f: F.when(f.isNotNull(), _result(f, F.lit(0), F.lit(0))).otherwise(_let(parts, dealt)))


def apart(found: Column) -> Column:
    """How many paragraphs `differences` found, repeats counted."""
    return F.aggregate(found, F.lit(0).cast("long"), lambda s, e: s + F.abs(e["n"]))


def differing(a: Column, b: Column) -> Column:
    """How many paragraphs two arrays of digests do not share, repeats counted."""
    return apart(differences(a, b)["found"])


def likeness(a: Column, b: Column, differing: Column) -> Column:
    """Shared paragraphs as a share of all: 1 for equal texts, 0 if nothing is shared."""
    both = F.size(a) + F.size(b)
    return (both - differing) / (both + differing).cast("double")


def fingerprint(stored: Column) -> Column:
    """The cells of a sketch as text."""
    return F.array_join(F.transform(F.flatten(stored), lambda c: F.concat_ws(".", *[F.hex(c[name]) for name in "nkmh"])), "-")


def range_ends(keys: DataFrame, ranges: int) -> DataFrame:
    """One row: ascending ends (k, h) of about `ranges` ranges of equal rows, and `steps`, enough to find one by halving.

    Every KEYS-th of KEYS times as many keys, which a hash draws; they deal the work and bear on no result. What one
    task sorts is KEYS pairs of numbers a range.
    """
    n = keys.count()
    drawn = keys.filter(F.pmod(F.xxhash64("k", "h", F.lit(7)), F.lit(1 << 30)) < min(1 << 30, (KEYS * ranges << 30) // max(1, n)))
    held = drawn.agg(F.array_sort(F.array_distinct(F.collect_list(F.struct("k", "h")))).alias("keys"))
    every = F.greatest(F.lit(1), F.call_function("div", F.size("keys"), F.lit(ranges)).cast("int"))
    ends = F.filter("keys", lambda _, i: (i + 1) % every == 0)
    return held.select(ends.alias("ends")).select("ends", F.ceil(F.log2(F.size("ends") + 2)).cast("int").alias("steps"))


def range_of(k: Column, h: Column, ends: Column, steps: Column) -> Column:
    """How many of the ends lie below a key, by halving."""
    key = F.struct(k.alias("k"), h.alias("h"))

    def halve(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["low"] + span["high"], 1)
        below = F.get(ends, middle) < key
        narrower = F.struct(F.when(below, middle + 1).otherwise(span["low"]).alias("low"), F.when(below, span["high"]).otherwise(middle).alias("high"))
        return F.when(span["low"] < span["high"], narrower).otherwise(span)

    return F.aggregate(F.sequence(F.lit(0), steps), F.struct(F.lit(0).alias("low"), F.size(ends).alias("high")), halve, lambda span: span["low"])


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """id, text and `next`, the text of the next row by ascending id; after the last row comes the first.

    Null texts are empty. Rows that share an id follow each other in the order of a hash of their texts; null ids
    come first; a single row is its own next. The rows are dealt by ranges of that order, so many that a range holds
    about `range_bytes` (more of very large tables, up to LARGE_BYTES); rows of one id may lie in several. The ends of
    the ranges are data of a table with one row, so the plan does not grow with them. The last row of a range takes the
    first of the next range, of which the order of range numbers alone (one row a range) goes through one task.
    """
    slim = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("k"), whole_text(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    stored = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(FEW, min(MANY, -(-stored // range_bytes)), -(-stored // LARGE_BYTES))
    ends = materialize(range_ends(slim.select("k", "h"), ranges))
    # the one row of ends goes to every task
    placed = slim.crossJoin(F.broadcast(ends)).select("id", "k", "text", "h", F.coalesce(range_of(F.col("k"), F.col("h"), F.col("ends"), F.col("steps")), F.lit(0)).alias("range"))
    ranged = placed.repartition(ranges, "range")
    # both branches read the same exchange
    heads = ranged.groupBy("range").agg(F.min_by(F.struct("id", "text"), F.struct("k", "h", "text")).alias("head"))
    numbers = placed.groupBy("range").agg(F.count(F.lit(1)).alias("rows"))
    everything = W.orderBy("range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    onward = numbers.select(F.col("range").alias("r"), F.coalesce(F.lead("range").over(W.orderBy("range")), F.first("range").over(everything)).alias("then"))
    follows = onward.join(heads, F.col("then") == F.col("range")).select("r", F.col("head.text").alias("after"))
    near = ranged.withColumns({"next": F.lead("text").over(W.partitionBy("range").orderBy("k", "h", "text"))})
    joined = near.join(follows, F.col("range") == F.col("r"), "left")
    return joined.select(F.col("id").alias(id_col), F.col("text").alias(text_col), F.coalesce("next", "after").alias("next"))


def op7_iblt_fingerprint(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, with likenesses.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; n_failed and n_direct
    add up what `differences` says of both comparisons.
    """
    near = with_next(docs)
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), (size - half).cast("int")), F.col("next").substr(F.lit(1), half))
    versions = F.transform(F.array(F.col("text"), edited, F.col("next")), lambda text: _let(digests(text), lambda d: F.struct(d.alias("d"), sketch(d, F.lit(CELLS)).alias("s"))))
    rows = near.select("doc_id", size.cast("long").alias("n_chars"), F.sha2(edited.cast("binary"), 256).alias("edited_sha256"), versions.alias("v"))
    first = F.col("v")[0]

    def against(other: Column) -> Column:
        found = differences(first["d"], other["d"], first["s"], other["s"])
        return _let(found, lambda r: F.struct(likeness(first["d"], other["d"], apart(r["found"])).alias("near"), r["failed"].alias("failed"), r["direct"].alias("direct")))

    both = F.transform(F.slice("v", 2, 2), against)
    rows = rows.select("doc_id", "n_chars", "edited_sha256", fingerprint(first["s"]).alias("fingerprint"), fingerprint(F.col("v")[1]["s"]).alias("edited_fingerprint"), both.alias("near"))
    number = lambda name: (F.col("near")[0][name] + F.col("near")[1][name]).cast("long")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", F.col("near")[0]["near"].alias("near_edited"), F.col("near")[1]["near"].alias("near_next"),
        number("failed").alias("n_failed"), number("direct").alias("n_direct"),
    )
