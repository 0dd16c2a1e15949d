"""Quality as a Bradley-Terry strength learned from preference pairs.

A pair is a good and a bad labelled document; the good one should win.  The strength of a
document is linear in measures of its writing, so the logistic loss sees only differences of
measures.  Strengths rank documents; the labelled rows say which share of them is best rejected, and the cut is the
quantile of the strengths of all documents at that level.  Scores are placed so that the cut lies at 0.7.
"""

from __future__ import annotations

import operator
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import encoded, map_batches, remainder, stored, table
from marlstone.llm.labels import fit_logistic, labelled_texts, share

# The fit sees at most about so many labelled rows, and so many pairs of them.
FIT_ROWS, FIT_PAIRS = 30_000, 60_000
# The quantile is off by at most one document in so many.
ACCURACY = 100_000
CUT = 0.7
SEED = 6

_ALL = bytes(range(256))
_CLASSES = {
    "symbols": b"#*$%&|<>@^~=+_{}[]\\",
    "marks": b"!?",
    "stops": b".,;:",
    "upper": bytes(range(65, 91)),
    "digits": b"0123456789",
    "beyond_ascii": bytes(range(128, 256)),
    "brackets": b"()/\"'`-",
}
_OTHERS = {name: bytes(b for b in _ALL if b not in members) for name, members in _CLASSES.items()}
MEASURES = [
    *_CLASSES, "word_length", "distinct_words", "repeats_neighbour", "top_word", "repeated_lines", "lines",
    "length", "short", "shouted_words", "bare_words", "long_words", "same_length_twice",
]


def measure(text: str | None) -> list[float]:
    """The measures of one text; all zero for an empty one."""
    raw = encoded(text)
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(MEASURES)
    size = len(raw)
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    rates = [len(raw.translate(None, others)) / size for others in _OTHERS.values()]
    lengths = list(map(len, words))
    return [
        *(min(5.0, 20 * r) for r in rates),
        min(20.0, sum(lengths) / n) / 5,
        len(counts) / n,
        sum(map(operator.eq, words, words[1:])) / n * 5,
        max(counts.values()) / n * 3,
        1 - len(set(lines)) / len(lines),
        min(3.0, 10 * len(lines) / n),
        np.log1p(n) / 5,
        max(0.0, 1 - n / 30),
        sum(map(bytes.isupper, words)) / n * 3,
        sum(map(bytes.isalpha, words)) / n,
        sum(map((20).__lt__, lengths)) / n * 5,
        sum(map(operator.eq, lengths, lengths[1:])) / n,
    ]


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    # Share of documents below the cut: 0 keeps all, 1 none.
    level: float

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int = FIT_PAIRS, seed: int = SEED) -> QualityModel:
    """Bradley-Terry strengths from random pairs of a good and a bad row."""
    spread = x.std(axis=0) if len(x) else np.ones(len(MEASURES))
    model = QualityModel(x.mean(axis=0) if len(x) else np.zeros(len(MEASURES)), np.where(spread > 1e-9, spread, 1.0),
                         np.zeros(len(MEASURES)), 0.0)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y != 1)
    if not len(good) or not len(bad):
        model.level = 0.0 if len(good) or not len(bad) else 1.0
        return model
    z = (x - model.mean) / model.scale
    draw = np.random.default_rng(seed)
    difference = z[draw.choice(good, pairs)] - z[draw.choice(bad, pairs)]
    model.weights = fit_logistic(difference, np.ones(pairs), 1e-4)
    strength = z @ model.weights
    # Every level is tried; of equally good ones the middle one counts.
    order = np.argsort(strength)
    is_good = y[order] == 1
    bad_below = np.concatenate([[0], np.cumsum(~is_good)]) / len(bad)
    good_below = np.concatenate([[0], np.cumsum(is_good)]) / len(good)
    gain = bad_below - good_below
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    model.level = float(best[len(best) // 2] / len(y))
    return model


def measured(rows: DataFrame) -> DataFrame:
    """``rows`` without its column ``text``, with ``x``, the measures of the text."""
    kept = [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept) + ", x array<double>"

    def make():
        def work(batch):
            texts = batch.column("text")
            x = [measure(t) for i in range(0, batch.num_rows, 64) for t in texts.slice(i, 64).to_pylist()]
            return {c: batch.column(c) for c in kept} | {"x": x}

        return work

    return map_batches(rows, schema, make)


def train_quality(docs: DataFrame, labels: DataFrame, learn, label: str = "quality") -> QualityModel:
    """Fit on at most about FIT_ROWS labelled rows for which ``learn`` (a condition on doc_id) holds."""
    there = labels.where(F.col(label).isNotNull() & learn).count()
    few = share(F.col("doc_id"), min(1.0, FIT_ROWS / max(there, 1)), SEED)
    rows = measured(labelled_texts(docs, labels, label, learn & few)).orderBy("doc_id").collect()
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(MEASURES))
    return fit_pairs(x, np.array([r["label"] for r in rows]))


def quality_rank(docs: DataFrame, model: QualityModel, carry: list[str] | None = None, text: str = "text") -> DataFrame:
    """``row`` (the columns ``carry``, else all, as one struct), ``score`` and ``predicted``.

    A null text counts as empty; an empty text has all measures at zero.  Equal texts get equal scores,
    an empty table no rows.  Extra columns of any name only travel in ``row``.
    """
    rows = docs.select(F.struct(*(carry or ["*"])).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    weights = model.weights / model.scale
    products = F.zip_with("x", F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b)
    strength = F.aggregate(products, F.lit(float(-model.mean @ weights)), lambda total, v: total + v)
    # Measured once; the quantile is merged from sketches of all tasks.
    ranked = stored(measured(rows).select("row", strength.alias("strength")), "strengths")
    cut = _cut(ranked, model.level)
    logit = F.col("strength") - F.lit(cut) + F.lit(float(np.log(CUT / (1 - CUT))))
    return ranked.select("row", (1 / (1 + F.exp(-logit))).alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))


def _cut(ranked: DataFrame, level: float) -> float:
    """The strength below which the share ``level`` of all documents lies; midway to the next one."""
    if level <= 0 or level >= 1:
        ends = ranked.agg(F.min("strength"), F.max("strength")).first()
        return 0.0 if ends[0] is None else ends[0] - 1.0 if level <= 0 else ends[1] + 1.0
    at = ranked.agg(F.percentile_approx("strength", level, ACCURACY).alias("cut")).first()["cut"]
    if at is None:
        return 0.0
    above = ranked.where(F.col("strength") > at).agg(F.min("strength")).first()[0]
    return at if above is None else (at + above) / 2


def op6_quality_rank(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_quality(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 4) != 2)
    ident = F.col("row.doc_id")
    return quality_rank(docs, model, ["doc_id"]).select(
        ident.alias("doc_id"), (remainder(ident, 4) == 2).alias("held_out"), "score", "predicted")
