"""Phrase collocations: counts of n-grams in weighted acyclic automata, united by prefix range, composed with the parts.

Every shard of texts gives a transducer of its n-grams. Transducers are cut at the same keys, united range by range,
and pruned to what occurs often enough. The parts of the phrases that stay are asked for by composing automata of the
asked parts with the transducer of their range.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankwell.llm import transducer as t
from rankwell.llm.common import materialize, whole_text

#: Least occurrences of a phrase, share (per cent) at which a longer one takes its place, phrases listed per language.
LEAST, TAKEN, LISTED = 10, 50, 2000
#: Bytes of text in a shard of one language, and in all shards that a task holds.
SHARD, HELD = 1 << 23, 1 << 25
#: Arcs of a range, about, and of the pieces from which its first keys are drawn; most ranges, and the keys drawn for each.
RANGE, EVERY, RANGES, DRAWN = 1 << 21, 1 << 14, 1 << 20, 64
#: Transducers united at once, and parts asked of one copy of a transducer.
FAN, ASKED = 256, 500_000
#: Lists that the first of each language are taken from, so that one large language is sorted in many tasks.
LISTS = 64

#: A-Z in lower case, a tab as a space, what ends a piece as a line feed.
_PIECES = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_AHEAD, _GAP = re.compile(rb" *(?:[^ \n]+(?: +[^ \n]+)?)?"), re.compile(rb"[ \n]")
_KEYS = pa.list_(pa.list_(pa.string()))


def windows(text: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """A long text in parts of about `size`, with the words behind each part that its last n-grams reach, and their number."""
    start = 0
    while len(text) - start > size:
        cut = max(text.rfind(b"\n", start, start + size), text.rfind(b" ", start + size // 2, start + size))
        if cut <= start:
            gap = _GAP.search(text, start + size)
            if gap is None:
                break
            cut = gap.start()
        ahead = _AHEAD.match(text, cut)
        yield text[start : ahead.end()], len(ahead.group().split())
        start = cut
    yield text[start:], 0


def count_grams(text: bytes, ahead: int) -> t.Grams:
    """The n-grams of pieces that begin in a text whose last `ahead` words belong to the next part."""
    pieces = pc.split_pattern(pa.array([text], pa.large_binary()), b"\n").flatten()
    split = pc.ascii_split_whitespace(pieces.cast(pa.large_string()))
    piece = np.repeat(np.arange(len(pieces)), np.diff(split.offsets.to_numpy()))
    coded = split.flatten().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    words, code = coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy(zero_copy_only=False)]
    if len(words) and not words[0].as_py():  # what stands before the first word and behind the last of a piece
        code, piece, words = code[code > 0] - 1, piece[code > 0], words[1:]
    n, own = max(1, len(words)), len(code) - ahead
    first = t.Level(np.zeros(len(words), np.int64), np.arange(len(words)), np.bincount(code[:own], minlength=len(words)))
    pair = piece[1:] == piece[:-1]
    keys, inverse = np.unique((code[:-1] * n + code[1:])[pair], return_inverse=True)
    begins = np.arange(len(pair)) < own
    second = t.Level(keys // n, keys % n, np.bincount(inverse, begins[pair], len(keys)).astype(np.int64))
    place = np.full(len(pair), -1)
    place[pair] = inverse
    triple = pair[:-1] & pair[1:] & begins[:-1]
    keys, counts = np.unique(place[:-1][triple] * n + code[2:][triple], return_counts=True)
    return t.Grams(words, (first, second, t.Level(keys // n, keys % n, counts.astype(np.int64))))


def _first_keys(grams: t.Grams) -> list[list[str]]:
    """A phrase out of every EVERY of each length, by which ranges may begin."""
    return [list(grams.spelled(k, i)) for k in range(3) for i in range(EVERY // 2, len(grams.levels[k]), EVERY)]


def shards(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Transducers of the n-grams of shards: lang, `shard` (a number), `arcs`, `keys` (phrases out of them), `data`.

    Null texts are empty, null languages are `und`. Tasks hold at most HELD bytes of text; a longer text is cut into
    parts that look ahead, so no n-gram is lost or counted twice.
    """
    def made(lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        for text, ahead in windows(b"\n".join(texts), SHARD):
            grams = count_grams(text, ahead)
            if grams.size:
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([grams.size], pa.int64()), pa.array([_first_keys(grams)], _KEYS), pa.array([t.build(grams).to_bytes()], pa.binary())], names=["lang", "arcs", "keys", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                pieces = text.as_py().encode().translate(_PIECES)
                held.setdefault(lang, []).append(pieces)
                sizes[lang] = sizes.get(lang, 0) + len(pieces) + 1
                while sizes[lang] >= SHARD or sum(sizes.values()) > HELD:
                    largest = max(sizes, key=sizes.get)
                    sizes.pop(largest)
                    yield from made(largest, held.pop(largest))
                    if lang not in sizes:
                        break
        for lang, texts in held.items():
            yield from made(lang, texts)

    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), whole_text(text_col).alias("text"))
    made_ = texts.mapInArrow(run, "lang string, arcs long, keys array<array<string>>, data binary")
    return made_.withColumn("shard", F.xxhash64("data"))


def cut_keys(parts: DataFrame) -> list[tuple[str, str, str, str]]:
    """Ascending keys (lang and words) at which ranges of about RANGE arcs begin.

    They are drawn by hash from the keys of all shards, about DRAWN for each range and a million at most, and only deal the
    work: any keys give the same counts.
    """
    arcs = parts.agg(F.sum("arcs")).first()[0] or 0
    ranges = min(RANGES, -(-arcs // RANGE))
    if ranges <= 1:
        return []
    keys = parts.select("lang", F.explode("keys").alias("key")).select("lang", F.col("key")[0].alias("a"), F.col("key")[1].alias("b"), F.col("key")[2].alias("c"))
    share = min(1.0, max(RANGES, DRAWN * ranges) * EVERY / arcs) if arcs > RANGES * EVERY else 1.0
    drawn = keys.filter(F.pmod(F.xxhash64("lang", "a", "b", "c", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = sorted(tuple(r) for r in drawn.collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def unite(parts: DataFrame, cuts: list[tuple[str, str, str, str]], least: int = LEAST) -> DataFrame:
    """One transducer for each language and range, of phrases that occur `least` times: lang, `range`, `words`
    (occurrences of all words in it), `data`. Very many shards are united in several steps, FAN at a time."""
    spark = parts.sparkSession
    shared = spark.sparkContext.broadcast(cuts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, shard, data in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                low, high = bisect_right(shared.value, (lang, "", "", "")), bisect_right(shared.value, (f"{lang}\0", "", "", ""))
                for number, grams in t.Transducer.from_bytes(data).grams().sliced([key[1:] for key in shared.value[low:high]]):
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([low + number], pa.int64()), pa.array([shard], pa.int64()), pa.array([0], pa.int64()), pa.array([t.build(grams).to_bytes()], pa.binary())], names=["lang", "range", "shard", "words", "data"])

    def united(last: bool):
        def run(table: pa.Table) -> pa.Table:
            grams = t.union([t.Transducer.from_bytes(d).grams() for d in table["data"].to_pylist()])
            words = int(grams.levels[0].count.sum())
            data = t.build(grams.pruned(least) if last else grams).to_bytes()
            return pa.table({"lang": table["lang"][:1], "range": table["range"][:1], "shard": pa.array([0 if last else table["shard"][0].as_py()], pa.int64()), "words": pa.array([words], pa.int64()), "data": pa.array([data], pa.binary())})

        return run

    schema = "lang string, range long, shard long, words long, data binary"
    pieces = parts.select("lang", "shard", "data").mapInArrow(cut, schema)
    count = parts.count()
    while count > FAN:
        count = -(-count // FAN)
        grouped = pieces.withColumn("group", F.pmod("shard", F.lit(count))).groupBy("lang", "range", "group")
        pieces = materialize(grouped.applyInArrow(united(False), schema).withColumn("shard", F.xxhash64("data")))
    return pieces.groupBy("lang", "range").applyInArrow(united(True), schema).select("lang", "range", "words", "data")


def _joined(columns: list[pa.Array]) -> pa.Array:
    columns = [c.cast(pa.string()) for c in columns]
    return columns[0] if len(columns) == 1 else pc.binary_join_element_wise(*columns, " ")


def _parts_of(cuts: list[tuple[str, str, str, str]]):
    """Candidates of a range, and the parts to ask for: phrase, its count, after which word it is cut, whether the part is
    the rest, the part, and the range that holds the part."""
    names = ["lang", "phrase", "a", "cut", "rest", "part", "range"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(*[batch.column(i).to_pylist() for i in range(2)], strict=True):
                grams = t.Transducer.from_bytes(data).grams()
                for k in (1, 2):
                    columns, counts = grams.phrases(k)
                    own = np.flatnonzero(counts)
                    columns, counts = [c.take(pa.array(own)) for c in columns], counts[own]
                    for at in range(1, k + 1):
                        for rest, some in ((False, columns[:at]), (True, columns[at:])):
                            spelled = zip(*[c.to_pylist() for c in some], *[[""] * len(own)] * (3 - len(some)), strict=True)
                            place = [bisect_right(cuts, (lang, *words)) for words in spelled] if len(own) else []
                            made = [pa.array([lang] * len(own), pa.string()), _joined(columns), pa.array(counts, pa.int64()), pa.array([at] * len(own), pa.int32()), pa.array([rest] * len(own), pa.bool_()), _joined(some), pa.array(place, pa.int64())]
                            yield pa.RecordBatch.from_arrays(made, names=names)

    return run


def _asked(parts: pa.Array) -> tuple[t.Grams, list[np.ndarray]]:
    """Parts as sorted phrases, and for each level where its counted phrases came from."""
    split = pc.split_pattern(parts.cast(pa.large_string()), " ")
    sizes = np.diff(split.offsets.to_numpy())
    coded = split.flatten().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    code, begin, n = rank[coded.indices.to_numpy(zero_copy_only=False)], np.cumsum(sizes) - sizes, max(1, len(order))
    levels, places, above, reach = [], [np.full(len(parts), -1) for _ in range(3)], np.zeros(len(parts), np.int64), np.arange(len(parts))
    for k in range(3):
        reach = reach[sizes[reach] > k]
        keys, inverse = np.unique(above[reach] * n + code[begin[reach] + k], return_inverse=True)
        levels.append(t.Level(keys // n, keys % n, np.zeros(len(keys), np.int64)))
        above[reach] = inverse
        ends = sizes[reach] == k + 1
        places[k][reach[ends]] = inverse[ends]
    return t.Grams(coded.dictionary.take(pa.array(order)), tuple(levels)), places


def _answer(key: tuple, held: pa.Table, asking: pa.Table) -> pa.Table:
    counts = np.zeros(len(asking), np.int64)
    if len(held) and len(asking):
        grams, places = _asked(asking["part"].combine_chunks())
        for found, place in zip(t.Transducer.from_bytes(held["data"][0].as_py()).compose(grams), places, strict=True):
            counts[place >= 0] = found[place[place >= 0]]
    return asking.select(["lang", "phrase", "a", "cut", "rest"]).append_column("f", pa.array(counts, pa.int64()))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), in decimals of 38 digits; null where a side is."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide(a) * wide(a)).cast("decimal(31,0)"), wide(left) * wide(right)).cast("long")


def candidates(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Phrases of two and three words that occur `least` times in a language: lang, phrase, a, l, r, n, score.

    `l` and `r` count the two parts at the cut with the lowest score, the first of equal ones; `n` counts all words of
    the language. Parts are asked for in the range that holds them; very many questions to one range are dealt over
    copies of its transducer, which is bounded.
    """
    parts = materialize(shards(docs, lang_col, text_col))
    cuts = cut_keys(parts)
    held = materialize(unite(parts, cuts, least))
    total = held.groupBy("lang").agg(F.sum("words").alias("n"))
    asked = held.select("lang", "data").mapInArrow(_parts_of(cuts), "lang string, phrase string, a long, cut int, rest boolean, part string, range long")
    asked = materialize(asked)
    many = asked.groupBy(F.col("lang").alias("in_lang"), F.col("range").alias("in_range")).agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("copies"))
    here = (F.col("lang") == F.col("in_lang")) & (F.col("range") == F.col("in_range"))
    copied = held.join(many, here).select("lang", "range", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "data")
    dealt = asked.join(many, here).withColumn("copy", F.pmod(F.xxhash64("phrase"), F.col("copies")).cast("int")).select(*[F.col(c).alias(c) for c in asked.columns], "copy")
    keys = ("lang", "range", "copy")
    told = copied.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(_answer, "lang string, phrase string, a long, cut int, rest boolean, f long")
    at = lambda cut, rest: F.max(F.when((F.col("cut") == cut) & (F.col("rest") == rest), F.col("f")))
    both = told.groupBy("lang", "phrase", "a").agg(at(1, False).alias("l1"), at(1, True).alias("r1"), at(2, False).alias("l2"), at(2, True).alias("r2"))
    cut = lambda k: F.when(F.col(f"l{k}").isNotNull(), F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    best = both.withColumn("best", F.least(cut(1), cut(2)))
    return best.join(total, "lang").select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def without_parts_of_longer(found: DataFrame, taken: int = TAKEN) -> DataFrame:
    """Candidates but for those inside a longer one that occurs at least `taken` per cent as often.

    A phrase of three words holds two of two; the most frequent longer phrase of each is aggregated before it is joined.
    """
    word = lambda i: F.split("phrase", " ")[i]
    longer = found.filter(F.size(F.split("phrase", " ")) == 3)
    inner = longer.select("lang", "a", F.explode(F.array(F.concat_ws(" ", word(0), word(1)), F.concat_ws(" ", word(1), word(2)))).alias("phrase"))
    most = inner.groupBy(F.col("lang").alias("in_lang"), F.col("phrase").alias("inside")).agg(F.max("a").alias("most"))
    joined = found.join(most, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inside")), "left")
    return joined.filter(F.col("most").isNull() | (F.col("most").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * taken)).select(*found.columns)


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, taken: int = TAKEN, listed: int = LISTED) -> DataFrame:
    """Each language's first phrases by score, count, and phrase: lang, rank, phrase, a, l, r, n, score.

    Texts in lower case (A-Z) are cut into pieces at `.,;:!?` and line ends, pieces into words at spaces and tabs. Null
    texts are empty, null languages are `und`; repeated rows count again; other columns are ignored; an empty table
    gives an empty one. The first are taken within lists of a language before they are ranked together.
    """
    found = materialize(candidates(docs, lang_col, text_col, least))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    listed_in = W.partitionBy("lang", "list").orderBy(*order)
    near = without_parts_of_longer(found, taken).withColumn("list", F.pmod(F.xxhash64("phrase"), F.lit(LISTS)))
    first = near.withColumn("rank", F.row_number().over(listed_in)).filter(F.col("rank") <= listed).drop("list")
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= listed)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The first 2000 phrases of each language in the documents."""
    return collocations(docs)


_CUT = "CAST(floor(CAST(1000000 AS HUGEINT) * a * a // (CAST({l} AS HUGEINT) * {r})) AS BIGINT)"
#: The same in SQL, by counting all n-grams.
SQL = f"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM d),
g AS MATERIALIZED (SELECT lang, k, p, count(*) AS f FROM (SELECT lang, k, unnest(list_transform(range(1, greatest(len(w) - k + 1, 0) + 1), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS p FROM w, (VALUES (1), (2), (3)) AS s(k)) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, p, f AS a, string_split(p, ' ') AS w FROM g WHERE k > 1 AND f >= {LEAST}),
cut AS (SELECT lang, k, p, a, w, unnest(range(1, k)) AS place FROM c),
s AS (SELECT cut.lang, cut.k, cut.p, a, place, l.f AS l, r.f AS r, {_CUT.format(l="l.f", r="r.f")} AS score FROM cut
  JOIN g AS l ON l.lang = cut.lang AND l.p = array_to_string(w[1:place], ' ') AND l.k = place JOIN g AS r ON r.lang = cut.lang AND r.p = array_to_string(w[place + 1:], ' ') AND r.k = cut.k - place),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, place) = 1),
longer AS (SELECT lang, inside, max(a) AS most FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS inside FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN longer ON longer.lang = best.lang AND inside = p AND k = 2 WHERE most IS NULL OR 100 * most < {TAKEN} * a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, n, score FROM kept JOIN n ON n.lang = kept.lang QUALIFY rank <= {LISTED}"""
