"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.llm.common import held_out, least_by_hash, materialize

#: Labelled rows that the model is fitted on, at most: those with the least hash of their id.
SAMPLE = 20_000
#: From this calibrated score on a text counts as toxic.
THRESHOLD = 0.7
#: Words that are an insult anywhere; the words that the labels show are learned beside them.
LEXICON = frozenset("idiot idiots moron morons stupid dumb loser losers trash scum pathetic worthless disgusting clown clowns imbecile bastard bitch asshole retard retarded cretin pig filth garbage vermin ugly hate kill die shut idiota imbecil estupido estúpido tonto basura asqueroso dummkopf trottel abschaum ekelhaft widerlich wertlos connard salaud crétin débile ordure dégoûtant minable".split())
#: Second-person words of the corpus languages.
SECOND = frozenset("you your yours yourself youre u ur ya tu te ton ta tes toi vous votre vos du dich dir dein deine ihr euch euer sie usted ustedes tú ti tus vosotros os".split())
#: Characters that stand for letters in disguised words.
PLAIN = str.maketrans("013457@$!|€+", "oieastasilet")
STRIP = ".,;:!?\"'()[]{}<>|…«»„“”%&#*$-_"
NEAR = 6
STEM = 5
NAMES = ("log_words", "hit_rate", "log_hits", "log_distinct_hits", "top_weight", "weight_rate", "near_you_rate", "you_rate", "capital_rate", "shouted_rate", "exclamation_rate", "question_rate", "symbol_rate", "repeated_rate", "disguised_rate", "disguised_hit_rate", "lexicon_rate", "digit_rate")
_UPPER = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123)])
_DIGITS = bytes(range(48, 58))
_SYMBOLS = bytes(b for b in range(33, 127) if chr(b) not in ".,;:!?'\"-" and not chr(b).isalnum())


@dataclass
class Lexicon:
    """How many toxic and other labelled texts hold each word, or each word beginning (ending in *)."""

    toxic: int
    other: int
    counts: dict[str, tuple[int, int]] = field(default_factory=dict)

    def weight(self, key: str, label: int | None = None) -> float:
        """Log odds of a word, 0 if it is no sign; `label` takes the text being looked at out of the counts."""
        found = self.counts.get(key)
        if not found:
            return 0.0
        a, b, p, n = *found, self.toxic, self.other
        if label is not None:
            # a disguised word may not have been counted for this text
            a, b, p, n = max(0, a - label), max(0, b - 1 + label), p - label, n - 1 + label
        odds = math.log(((a + 0.5) / (p + 1)) / ((b + 0.5) / (n + 1)))
        return odds if odds >= 1.4 and a >= 2 else 0.0


class _Words(dict):
    """What a written word is: 0 for most, or its flags (disguised, shouted, second person) and its plain form."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        super().__init__()
        self.counts = counts

    def __missing__(self, written: str):
        if len(self) > 300_000:
            self.clear()
        bare = written.strip(STRIP)
        word = bare.lower()
        core = written.strip(".,;:?\"'()").lower()
        plain = core.translate(PLAIN).strip(STRIP)
        disguised = plain != word and any(c.isalpha() for c in core) and not core.strip("!$*%&#|").isalpha() and not core.isdigit()
        hidden = disguised and (plain in LEXICON or plain in self.counts)
        if hidden:
            word = plain
        stem = word[:STEM] + "*"
        known = word in LEXICON or word in self.counts or stem in self.counts
        shouted = len(bare) > 2 and bare.isupper()
        value = (known, disguised, hidden, shouted, word in SECOND, word, stem) if known or disguised or shouted or word in SECOND else 0
        self[written] = value
        return value


def features(text: str | None, words: _Words, lexicon: Lexicon, label: int | None = None) -> list[float]:
    """The dense features of one whole text, in the order of NAMES."""
    text = text or ""
    written = text.split()
    n = max(1, len(written))
    marked = [(i, m) for i, m in enumerate(map(words.__getitem__, written)) if m]
    weights, hits, you, listed, disguised, hidden, shouted = [], [], [], 0, 0, 0, 0
    distinct = set()
    for i, (known, masked, was_hidden, loud, second, word, stem) in marked:
        disguised += masked
        shouted += loud
        if second:
            you.append(i)
        if known:
            weight = max(lexicon.weight(word, label), lexicon.weight(stem, label))
            if word in LEXICON:
                listed += 1
                weight = max(weight, 2.0)
            if weight:
                hits.append(i)
                weights.append(weight)
                distinct.add(word)
                hidden += was_hidden
    near, k = 0, 0
    for i in hits:
        while k < len(you) and you[k] < i - NEAR:
            k += 1
        near += k < len(you) and you[k] <= i + NEAR
    raw = text.encode("utf-8", "replace")
    size = max(1, len(raw))
    of = lambda kind: len(raw) - len(raw.translate(None, kind))
    letters = of(_LETTERS) or 1
    return [
        math.log1p(len(written)), len(hits) / n, math.log1p(len(hits)), math.log1p(len(distinct)), max(weights, default=0.0), sum(weights) / n, near / n, len(you) / n,
        of(_UPPER) / letters, shouted / n, raw.count(b"!") / size, raw.count(b"?") / size, of(_SYMBOLS) / size,
        (raw.count(b"!!") + raw.count(b"??") + raw.count(b"..")) / size, disguised / n, hidden / n, listed / n, of(_DIGITS) / size,
    ]


def _feature_column(text: Column, lexicon: Lexicon, label: Column | None = None) -> Column:
    words: list[_Words] = []

    def run(texts: pa.Array, labels: pa.Array) -> pa.Array:
        if not words:
            words.append(_Words(lexicon.counts))
        rows = [features(t, words[0], lexicon, y) for t, y in zip(texts.to_pylist(), labels.to_pylist(), strict=True)]
        return pa.array(rows, pa.list_(pa.float64()))

    made = F.arrow_udf(run, "array<double>")
    return made(text, F.lit(None).cast("int") if label is None else label.cast("int"))


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    scale: IsotonicRegressionModel | None

    def score(self, df: DataFrame, text_col: str = "text", score_col: str = "score") -> DataFrame:
        """df with `score_col`, the calibrated probability (0 to 1) that the text is toxic; every column of df stays.

        Null and empty texts are scored as texts without words. Without labels of both kinds the score rests on the
        fixed lexicon alone: the share of insults, times 20, at most 1. Equal calibrated scores are kept in the
        order of the trees by a thousandth.
        """
        packed = df.select(F.struct(*[df[c] for c in df.columns]).alias("__row"), _feature_column(df[text_col], self.lexicon).alias("__f"))
        if self.trees is None or self.scale is None:
            made = packed.withColumn("__s", F.least(F.lit(1.0), 20 * F.col("__f")[NAMES.index("lexicon_rate")]))
        else:
            made = packed.select("__row", array_to_vector("__f").alias("__f"))
            made = self.trees.transform(made).withColumn("__p", vector_to_array("__prob")[1]).withColumn("__v", array_to_vector(F.array("__p")))
            made = self.scale.transform(made).withColumn("__s", F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.999 * F.col("__iso") + 0.001 * F.col("__p"))))
        kept = [c for c in df.columns if c != score_col]
        return made.select(*[F.col("__row")[c].alias(c) for c in kept], F.col("__s").alias(score_col))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Fit on at most `sample` labelled rows outside the held-out third.

    The sample's ids and labels are few by that bound and are broadcast to the scan of the texts. Word counts come
    from its texts; three quarters of it grow the trees, one quarter calibrates them. While the features of a
    sample text are counted, that text is left out of the word counts. Conflicting labels of one id: the larger
    wins; of several texts of one id the least is learned from. Null labels are not used.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("__y"))
    known = least_by_hash(known, F.xxhash64("__id"), sample)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(known), "__id")
    texts = materialize(texts.groupBy("__id").agg(F.max("__y").alias("__y"), F.min("__text").alias("__text")))
    totals = dict(texts.groupBy("__y").count().collect())
    toxic, other = totals.get(1, 0), totals.get(0, 0)
    if toxic < 5 or other < 5:
        return ToxicityModel(Lexicon(toxic, other), None, None)
    least = max(3, math.ceil(toxic / 100))
    words = texts.select("__y", F.explode(F.array_distinct(F.split(F.lower("__text"), r"[^\p{L}\p{N}]+"))).alias("w")).filter(F.length("w") > 0)
    stems = texts.select("__y", F.explode(F.array_distinct(F.transform(F.filter(F.split(F.lower("__text"), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > STEM), lambda w: F.concat(F.substring(w, 1, STEM), F.lit("*"))))).alias("w"))
    counts = words.unionByName(stems).groupBy("w").agg(F.sum("__y").cast("int").alias("a"), F.sum(1 - F.col("__y")).cast("int").alias("b"))
    signs = counts.filter((F.col("a") >= least) & ((F.col("a") + 0.5) / (toxic + 1) >= 4 * (F.col("b") + 0.5) / (other + 1)))
    # each sign is in one toxic text of a hundred at least, so the sample bounds their number
    best = signs.orderBy("w").collect()
    lexicon = Lexicon(toxic, other, {r["w"]: (r["a"], r["b"]) for r in best})
    table = texts.select("__id", F.col("__y").cast("double").alias("label"), array_to_vector(_feature_column(F.col("__text"), lexicon, F.col("__y"))).alias("__f"))
    table = materialize(table.orderBy("__id").coalesce(1)).coalesce(2)
    grow, adjust = (table.filter(test) for test in (F.pmod(F.xxhash64("__id"), F.lit(4)) != 0, F.pmod(F.xxhash64("__id"), F.lit(4)) == 0))
    if grow.select("label").distinct().count() < 2:
        return ToxicityModel(lexicon, None, None)
    boosting = GBTClassifier(featuresCol="__f", labelCol="label", predictionCol="__pred", maxIter=20, maxDepth=3, stepSize=0.3, seed=7, minInstancesPerNode=2, checkpointInterval=-1)
    trees = boosting.setRawPredictionCol("__raw").setProbabilityCol("__prob").fit(grow)
    scored = trees.transform(adjust).select("label", array_to_vector(F.array(vector_to_array("__prob")[1])).alias("__v"))
    if scored.isEmpty():
        return ToxicityModel(lexicon, None, None)
    scale = IsotonicRegression(featuresCol="__v", labelCol="label", predictionCol="__iso").fit(scored)
    return ToxicityModel(lexicon, trees, scale)


def op3_toxicity_gbt(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity of every document: doc_id, held_out, score, predicted."""
    scored = fit(docs, labels).score(docs.select("doc_id", "text"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    columns = docs.columns
    scored = fit(docs, labels).score(docs, score_col="__toxicity")
    return scored.filter(F.col("__toxicity") < THRESHOLD).select(*columns)
