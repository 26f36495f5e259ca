"""Quality by co-training: a text view and a metadata view teach each other, then score together."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.llm.common import held_out, least_by_hash, materialize

#: Rows that a view is fitted on, at most: labelled ones, and those that the other view has labelled in a round.
SAMPLE = 20_000
TAUGHT = 20_000
ROUNDS = 5
#: Share of all unlabelled rows that each view labels for the other, more by this in each round, and how sure it must be.
SHARE = 0.05
SURE = 0.95
#: Log odds are counted in steps of this width, up to this many steps on either side.
STEP = 0.02
STEPS = 1500
#: A document is kept if the combined probability of good quality is at least this.
THRESHOLD = 0.5
#: Ridge penalty of the logistic fits.
RIDGE = 1.0
SOURCES = 32
LANGS = 8
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"()-?!|")


def text_features(text: str | None) -> list[float]:
    """What the text itself shows; no label, no metadata."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    size = max(1, len(raw))
    words = text.split()
    n = max(1, len(words))
    lines = [line for line in text.split("\n") if line]
    upper, lower, digits, marks = (size - len(raw.translate(None, chars)) for chars in (_UPPER, _LOWER, _DIGITS, _MARKS))
    seen = Counter(words)
    rates = (
        marks / size,
        upper / max(1, upper + lower),
        digits / size,
        raw.count(b"|") / n,
        raw.count(b"!") / n,
        (raw.count(b".") + raw.count(b"?")) / n,
        raw.count(b",") / n,
        raw.count(b"http") / n,
        1 - len(set(lines)) / max(1, len(lines)),
        1 - len(seen) / n,
        max(seen.values(), default=0) / n,
        sum(raw.count(w) for w in (b"{", b"}", b"<", b">", b";")) / n,
        abs(size / n - 6.5) / 6.5,
    )
    return [float(np.log(1e-3 + r)) for r in rates] + [float(np.log1p(len(words))), float(np.log1p(len(words) / max(1, len(lines))))]


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> list[float]:
    """What the page's metadata shows: hashed source and language, stated size."""
    import zlib

    row = [0.0] * (SOURCES + LANGS + 2)
    row[zlib.crc32((source or "").encode()) % SOURCES] = 1.0
    row[SOURCES + zlib.crc32((lang or "").encode()) % LANGS] = 1.0
    size = float(np.log1p(max(0, n_chars or 0)))
    row[-2:] = size, float(size > 5)
    return row


@dataclass
class View:
    """A logistic classifier on standardised features, with the line that calibrates its margin."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> View:
        mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        return cls(mean, scale, logistic((x - mean) / scale, y))

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return self.slope * (z @ self.weights[:-1] + self.weights[-1]) + self.shift

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Platt's line through held-back labels."""
        if len(y) > 10 and 0 < y.mean() < 1:
            fitted = logistic(self.margin(x)[:, None], y)
            if fitted[0] > 0:
                self.slope, self.shift = float(fitted[0]), float(fitted[1])


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights and intercept of a ridge logistic regression, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return w


#: Gives a lesson for two views, a share of the pool and the share of good labels.
Teacher = Callable[[list[View], float, float], "Lesson"]


@dataclass
class Lesson:
    """Rows that the views have labelled: features of both views, and each view's labels (0, 1, or -1 for none)."""

    data: tuple[np.ndarray, np.ndarray]
    by: tuple[np.ndarray, np.ndarray]


def steps_of(margin: np.ndarray) -> np.ndarray:
    """Log odds as whole steps."""
    return np.clip(np.floor(margin / STEP), -STEPS, STEPS).astype(np.int32)


def sure_steps(counts: np.ndarray, share: float, prior: float) -> tuple[int, int]:
    """The step from which rows are labelled good and the one up to which they are labelled bad.

    `counts` holds the rows of each step from -STEPS on. The surest `share` of the rows are taken, good and bad in
    the proportion of the labels; rows of one step are taken together, and none that is less sure than SURE.
    """
    least = int(np.ceil(np.log(SURE / (1 - SURE)) / STEP))
    want = share * counts.sum()
    from_top, from_below = np.cumsum(counts[::-1]), np.cumsum(counts)
    good = STEPS - int(np.searchsorted(from_top, max(1.0, want * prior)))
    bad = int(np.searchsorted(from_below, max(1.0, want * (1 - prior)))) - STEPS
    return max(good, least), min(bad, -least - 1)


def labels_of(steps: np.ndarray, cut: tuple[int, int]) -> np.ndarray:
    return np.where(steps >= cut[0], 1, np.where(steps <= cut[1], 0, -1))


def teach_in_memory(data: tuple[np.ndarray, np.ndarray]) -> Teacher:
    """Lessons from a pool that is held as arrays."""

    def teach(views: list[View], share: float, prior: float) -> Lesson:
        by = []
        for view, x in zip(views, data, strict=True):
            steps = steps_of(view.margin(x))
            by.append(labels_of(steps, sure_steps(np.bincount(steps + STEPS, minlength=2 * STEPS + 1), share, prior)))
        some = (by[0] >= 0) | (by[1] >= 0)
        return Lesson((data[0][some], data[1][some]), (by[0][some], by[1][some]))

    return teach


def teach_from_table(pool: DataFrame, width: int, most: int = TAUGHT) -> Teacher:
    """Lessons from every row of a table of features (`f`, the first `width` of the text) and hashes (`h`).

    Both views score all rows in each round. What reaches the driver is the number of rows at each step, bounded by
    STEPS, and of the rows that are then labelled the `most` with the least hash, to be fitted on.
    """

    def teach(views: list[View], share: float, prior: float) -> Lesson:
        def run(rows: pa.Array) -> pa.Array:
            x = rows.flatten().to_numpy().astype(float).reshape(len(rows), -1)
            made = [pa.array(steps_of(view.margin(part))) for view, part in zip(views, (x[:, :width], x[:, width:]), strict=True)]
            return pa.StructArray.from_arrays(made, ["v0", "v1"])

        scored = pool.select("h", "f", F.arrow_udf(run, "v0 int, v1 int")("f").alias("s"))
        each = F.explode(F.array(*[F.struct(F.lit(k).alias("view"), F.col(f"s.v{k}").alias("step")) for k in (0, 1)])).alias("e")
        counts = np.zeros((2, 2 * STEPS + 1))
        for row in scored.select(each).groupBy("e.view", "e.step").count().collect():
            counts[row["view"], row["step"] + STEPS] = row["count"]
        labels, sure = [], 0
        for k in (0, 1):
            good, bad = sure_steps(counts[k], share, prior)
            steps = np.arange(2 * STEPS + 1) - STEPS
            sure = max(sure, int(counts[k][(steps >= good) | (steps <= bad)].sum()))
            labels.append(F.when(F.col(f"s.v{k}") >= good, 1).when(F.col(f"s.v{k}") <= bad, 0).otherwise(-1).alias(f"by{k}"))
        found = least_by_hash(scored.select("h", "f", *labels).filter("by0 >= 0 or by1 >= 0"), F.col("h"), most, sure).toPandas()
        x = np.array(found["f"].tolist(), float).reshape(len(found), -1) if len(found) else np.empty((0, width + SOURCES + LANGS + 2))
        return Lesson((x[:, :width], x[:, width:]), (found["by0"].to_numpy(), found["by1"].to_numpy()))

    return teach


def co_train(text: np.ndarray, meta: np.ndarray, label: np.ndarray, rounds: int = ROUNDS, teach: Teacher | None = None) -> tuple[View, View, float]:
    """Both calibrated views and the log odds of good quality. `label` is 0, 1, or -1 for unlabelled rows, which
    are the pool unless `teach` draws lessons from one of its own.

    A fifth of the labelled rows calibrates and is never trained on. In each round each view labels the unlabelled
    rows it is surest of, good and bad in the proportion of the labels, and hands them to the other view, which is
    fitted on them and the labelled rows. Labels are given anew in each round, so that early errors do not stay.
    """
    rows = np.flatnonzero(label >= 0)
    back = rows[np.arange(len(rows)) % 5 == 4]
    train = np.setdiff1d(rows, back)
    prior = float(np.clip(label[train].mean(), 1e-3, 1 - 1e-3))
    data = (text, meta)
    teach = teach or teach_in_memory((text[label < 0], meta[label < 0]))
    views: list[View] = []
    for step in range(rounds + 1):
        lesson = teach(views, SHARE * step, prior) if step else None
        views = []
        for k in (0, 1):
            x, y = data[k][train], label[train]
            if lesson is not None:
                told = lesson.by[1 - k] >= 0
                x, y = np.concatenate([x, lesson.data[k][told]]), np.concatenate([y, lesson.by[1 - k][told]])
            view = View.fit(x, y)
            view.calibrate(data[k][back], label[back])
            views.append(view)
    return views[0], views[1], float(np.log(prior / (1 - prior)))


@dataclass
class QualityModel:
    text: View | None
    meta: View | None
    prior: float

    def score(self, text: Column, source: Column, lang: Column, n_chars: Column) -> Column:
        """Struct of three probabilities of good quality: by the text, by the metadata, and combined.

        The views are taken as independent given the quality, so their calibrated log odds add up, less the prior.
        Null and empty texts and missing metadata have features as well and are scored like any other row. Without
        labels of both kinds every score is 1: nothing is known against a document.
        """
        kind = pa.struct([("text_score", pa.float64()), ("meta_score", pa.float64()), ("score", pa.float64())])

        def run(texts: pa.Array, sources: pa.Array, langs: pa.Array, sizes: pa.Array) -> pa.Array:
            n = len(texts)
            if self.text is None or self.meta is None or not n:
                ones = pa.array(np.ones(n))
                return pa.StructArray.from_arrays([ones, ones, ones], fields=list(kind))
            x = np.array([text_features(t) for t in texts.to_pylist()])
            m = np.array([meta_features(*row) for row in zip(sources.to_pylist(), langs.to_pylist(), sizes.to_pylist(), strict=True)])
            a, b = self.text.margin(x), self.meta.margin(m)
            return pa.StructArray.from_arrays([pa.array(1 / (1 + np.exp(-np.clip(v, -60, 60)))) for v in (a, b, a + b - self.prior)], fields=list(kind))

        made = F.arrow_udf(run, "text_score double, meta_score double, score double")
        return made(text, source.cast("string"), lang.cast("string"), n_chars.cast("long"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, taught: int = TAUGHT, label_col: str = "quality") -> QualityModel:
    """Co-train on at most `sample` labelled documents, those with the least hash of their id, and all unlabelled
    ones, of which at most `taught` a round are fitted on once they have labels; held-out rows take no part. What
    reaches the driver is bounded by these two numbers. Of several labelled rows with one id one is taken.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("__id")).agg(F.min(label_col).cast("int").alias("__y"))
    known = least_by_hash(known, F.xxhash64("__id"), sample)

    def run(texts: pa.Array, sources: pa.Array, langs: pa.Array, sizes: pa.Array) -> pa.Array:
        rows = [text_features(t) + meta_features(s, g, n) for t, s, g, n in zip(texts.to_pylist(), sources.to_pylist(), langs.to_pylist(), sizes.to_pylist(), strict=True)]
        return pa.array(rows, pa.list_(pa.float32()))

    both = F.arrow_udf(run, "array<float>")("text", F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long"))
    named = docs.select(F.col("doc_id").alias("__id"), "text", "source", "lang", "n_chars").filter(F.col("__id").isNotNull() & ~held_out(F.col("__id")))
    seen = materialize(named.select("__id", both.alias("f"), F.xxhash64("__id", "text", "source", "lang", "n_chars").alias("h")))
    # of several rows with one id the one with the least hash, chosen before anything reaches the driver
    rows = seen.join(F.broadcast(materialize(known)), "__id").groupBy("__id").agg(F.min("__y").alias("__y"), F.min_by("f", F.struct("h", "f")).alias("f")).toPandas().sort_values("__id", kind="stable")
    # ids may run with the source or the time, so the rows are put in the order of a hash before they are cut
    rows = rows.iloc[np.argsort((rows["__id"].to_numpy(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16), kind="stable")] if len(rows) else rows
    label = rows["__y"].to_numpy()
    if min((label == 0).sum(), (label == 1).sum()) < 5:
        return QualityModel(None, None, 0.0)
    x = np.array(rows["f"].tolist(), float)
    width = x.shape[1] - (SOURCES + LANGS + 2)
    rest = seen.join(labels.select(F.col("doc_id").alias("__id")).distinct(), "__id", "left_anti").select("h", "f")
    return QualityModel(*co_train(x[:, :width], x[:, width:], label, teach=teach_from_table(materialize(rest), width, taught)))


def op5_cotrain_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality of every document: doc_id, held_out, text_score, meta_score, score, predicted (1: good)."""
    model = fit(docs, labels)
    made = model.score(F.col("text"), F.col("source"), F.col("lang"), F.col("n_chars"))
    scored = docs.select("doc_id", made.alias("s")).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "s.*")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def reject_poor(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents at or above the threshold, with all their columns."""
    model = fit(docs, labels)
    made = model.score(docs["text"], docs["source"], docs["lang"], docs["n_chars"])
    return docs.withColumn("__quality", made["score"]).filter(F.col("__quality") >= THRESHOLD).drop("__quality")
