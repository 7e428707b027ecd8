"""Severity of toxic text by cumulative-link ordinal regression on sparse features.

Features are the distinct words of a text and, for words of six bytes or more, their heads of four and five bytes, so that inflected
forms share evidence. The fit takes at most `sample` labelled rows, those with the smallest hashes of their ids, and of their features the
`FEATURES` that tell toxic from clean rows best, by the signed root z of their likelihood ratio; both bound the model, neither switches with the
number of rows. Equal texts count once. The model is

    P(grade <= k) = sigmoid(threshold_k - w . x),   threshold_1 < threshold_2

with one w for both thresholds, fitted by Adam on the penalised likelihood. A row labelled clean has grade 0. The labels hold no severity: a row labelled toxic
has grade 1 or 2, which of them is open, so its likelihood is P(grade >= 1), and the second threshold lies where half of the toxic rows of a fold are above it, scored by
a fit that has not seen them. Grade 2 thus means more toxic than the usual toxic row. A weight is w = min(1, z / z0)^6 u with u penalised, where z0 = sqrt(2 log M) is what the
strongest of M features without a meaning reaches: weak features are held near 0 instead of being cut off, at any number of rows. The penalty is the one
that tells held-out rows best, in five folds of the labelled rows; their recall and precision stay with the model. A text's severity is its expected grade; it is
rejected if P(grade >= 1) is at least one half. Every row of docs is scored, whole.

Null and empty texts have no features. Labels that are null, or whose id is null or unknown, take no part; an id labelled several times is toxic if any of them
says so. Features that tell equally much are taken in the order of their bytes. Without labelled rows of both kinds nothing is rejected and severity is 0. Rows are independent, so repeated rows get equal results. A very long text is split into words once, in one row. `graded` drops other
columns, `accepted` keeps all, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.llm.common import WORD_BYTES, Scratch, as_bytes, released

SAMPLE, FEATURES, FOLDS = 20_000, 4_000, 5
PENALTIES = (0.1, 0.3, 1.0, 3.0)
#: How steeply weights follow their evidence; the grade of a row that is 1 or 2, which is not known.
STEEP, OPEN = 6, 3
#: Steps of the fit; the folds, which only choose the penalty, take a third of them.
STEPS = 400


def features(text: bytes) -> set[bytes]:
    words = set(text.translate(WORD_BYTES).split())
    long = [w for w in words if len(w) > 5]
    return words | {w[:4] + b"*" for w in long} | {w[:5] + b"*" for w in long}


@dataclass
class Model:
    weights: dict[bytes, float] = field(default_factory=dict)
    thresholds: tuple[float, float] = (np.inf, np.inf)
    #: Recall and precision on rows that the fit had not seen.
    recall: float = 0.0
    precision: float = 0.0

    def grades(self, texts: Iterable[bytes]) -> np.ndarray:
        """P(grade >= 1) and P(grade >= 2) of each text."""
        known = frozenset(self.weights)
        if not self.weights:
            return np.zeros((len(list(texts)), 2))
        eta = np.array([sum(self.weights[f] for f in sorted(features(t) & known)) for t in texts], float)
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds)[None, :] - eta[:, None], -500, 500)))


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))


def fit_ordinal(rows: list[np.ndarray], grade: np.ndarray, n: int, penalty: float = 0.1, steps: int = STEPS, scale: np.ndarray | None = None) -> tuple[np.ndarray, tuple[float, float]]:
    """Shared weights and two ordered thresholds. rows: the features of each row, as numbers below n; grades are 0, 1, 2 or OPEN."""
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.concatenate(rows) if len(of) else np.empty(0, np.int64)
    scale = np.ones(n) if scale is None else scale
    p = np.zeros(n + 2)
    p[n], p[n + 1] = 1.0, 0.0  # the lower threshold, the log of the distance to the upper one
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        eta = np.bincount(of, (p[:n] * scale)[at], len(rows))
        gap = np.exp(p[n + 1])
        low, high = _sigmoid(p[n] - eta), _sigmoid(p[n] + gap - eta)
        above = np.select([grade == 0, grade == 1], [low, high], 1.0)
        below = np.select([grade == 0, grade == 2], [0.0, high], low)
        share = np.maximum(above - below, 1e-12)
        d_low, d_high = low * (1 - low), high * (1 - high)
        # derivative of -log(share) by each threshold
        by_low = np.select([grade == 0, grade == 2], [-d_low, 0.0], d_low) / share
        by_high = np.where(grade == 1, -d_high, np.where(grade == 2, d_high, 0.0)) / share
        by_weight = np.bincount(at, -(by_low + by_high)[of], n) * scale + penalty * p[:n]
        # a weak hold on the distance, for labels without a second grade
        g = np.r_[by_weight, (by_low + by_high).sum(), (by_high * gap).sum() + 0.1 * p[n + 1]] / len(rows)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return p[:n] * scale, (float(p[n]), float(p[n] + np.exp(p[n + 1])))


def evidence(rows: list[np.ndarray], toxic: np.ndarray, n: int) -> np.ndarray:
    """|z| of each feature: the root of twice its log likelihood ratio, toxic against clean rows."""
    of, at = np.repeat(toxic, [len(r) for r in rows]), np.concatenate(rows)
    whole, bad = len(rows), toxic.sum()
    seen, told = np.bincount(at, minlength=n).astype(float), np.bincount(at, of, n)
    term = lambda x, a, b: np.where(x > 0, x * np.log(np.maximum(x, 1e-300) * whole / np.maximum(a * b, 1e-300)), 0.0)
    both = term(told, seen, bad) + term(seen - told, seen, whole - bad) + term(bad - told, whole - seen, bad) + term(whole - seen - bad + told, whole - seen, whole - bad)
    return np.sqrt(np.maximum(2 * both, 0))


def chosen_fit(rows: list[np.ndarray], toxic: np.ndarray, n: int, noise: float) -> tuple[np.ndarray, tuple[float, float], float, float]:
    """Weights and thresholds under the penalty that tells held-out rows best, with the recall and precision there."""
    fold = np.empty(len(rows), int)
    for kind in (0, 1):
        some = np.flatnonzero(toxic == kind)
        fold[some] = np.arange(len(some)) % FOLDS
    grade = np.where(toxic > 0, OPEN, 0)

    def fit(pick: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, tuple[float, float]]:
        some = [rows[i] for i in pick]
        return fit_ordinal(some, grade[pick], n, penalty, steps, scale=np.minimum(1, evidence(some, toxic[pick], n) / noise) ** STEEP)

    best = None
    for penalty in PENALTIES:
        over = np.empty(len(rows))
        for k in range(FOLDS):
            w, (low, _) = fit(np.flatnonzero(fold != k), penalty, STEPS // 3)
            held = np.flatnonzero(fold == k)
            over[held] = [w[rows[i]].sum() - low for i in held]
        loss = np.logaddexp(0, np.where(toxic > 0, -over, over)).sum()
        if best is None or loss < best[0]:
            best = loss, penalty, over
    _, penalty, over = best
    w, (low, _) = fit(np.arange(len(rows)), penalty, STEPS)
    caught = ((over >= 0) & (toxic > 0)).sum()
    return w, (low, low + max(1.0, float(np.median(over[toxic > 0])))), float(caught / max(1, toxic.sum())), float(caught / max(1, (over >= 0).sum()))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    scratch = Scratch(spark)
    wanted = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic")).dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    wanted = scratch.write(wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "wanted")
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    rows = scratch.write(texts.join(F.broadcast(wanted), "doc_id").select("text", (F.col("toxic") > 0).alias("toxic")).groupBy("text").agg(F.max("toxic").alias("toxic")), "rows")
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return Model()

    def listed(batches):
        for b in batches:
            for text, toxic in zip(as_bytes(b.column("text")), b.column("toxic").to_pylist()):
                f = list(features(text))
                yield pa.RecordBatch.from_arrays([pa.array(f, pa.binary()), pa.array([toxic] * len(f), pa.bool_())], names=["feature", "toxic"])

    counts = rows.mapInArrow(released(listed), "feature binary, toxic boolean").groupBy("feature").agg(F.count_if("toxic").alias("t"), F.count("*").alias("n"))
    t, c = F.col("t").cast("double"), (F.col("n") - F.col("t")).cast("double")
    whole = n[False] + n[True]
    expected = lambda x, of, part: x * F.log((x / of) / (F.col("n") / part))
    absent = lambda x, of: (of - x) * F.log(((of - x) / of) / ((whole - F.col("n")) / whole))
    seen = lambda x, of: F.when(x > 0, expected(x, of, whole)).otherwise(0.0) + F.when(x < of, absent(x, of)).otherwise(0.0)
    told = scratch.write(counts.where("n > 1").select("feature", (seen(t, n[True]) + seen(c, n[False])).alias("z")), "told")
    number = {bytes(r["feature"]): i for i, r in enumerate(told.orderBy(F.desc("z"), "feature").limit(FEATURES).collect())}
    if not number:
        return Model()
    noise = float(np.sqrt(2 * np.log(max(2, told.count()))))

    def indexed(batches):
        known = frozenset(number)
        for b in batches:
            found = [features(x) for x in as_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array([sorted(number[f] for f in fs & known) for fs in found], pa.list_(pa.int32())), b.column("toxic")], names=["at", "toxic"])

    # rows in one order, so that every run sums alike
    sampled = sorted((r["toxic"], r["at"]) for r in rows.mapInArrow(released(indexed), "at array<int>, toxic boolean").collect())
    w, thresholds, recall, precision = chosen_fit([np.array(at, np.int64) for _, at in sampled], np.array([float(t) for t, _ in sampled]), len(number), noise)
    scratch.drop("wanted", "rows", "told")
    return Model({f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-6}, thresholds, recall, precision)


def graded(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity (expected grade, 0 to 2), grade (the likeliest), toxic_probability and rejected, a row per row of docs."""

    def run(batches):
        for b in batches:
            p = model.grades(as_bytes(b.column("text")))
            each = np.c_[1 - p[:, 0], p[:, 0] - p[:, 1], p[:, 1]]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *map(pa.array, (p.sum(1), each.argmax(1).astype(np.int32), p[:, 0], p[:, 0] >= 0.5))],
                names=["doc_id", "severity", "grade", "toxic_probability", "rejected"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(released(run), "doc_id long, severity double, grade int, toxic_probability double, rejected boolean")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all columns, that are not rejected."""
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(model.grades(as_bytes(b.column(at).cast(pa.string())))[:, 0] < 0.5))

    return docs.mapInArrow(released(run), docs.schema)
