"""Language of a text: sparse multinomial logistic regression on character n-grams.

Characters (lower case) are counted in runs of one to three, hashed to a fixed number of
columns, weighted by TF-IDF and brought to length one.  Document frequencies come from every
training document; the weights from a bounded, documented number of documents per language,
trained online with follow-the-regularised-leader and elastic-net penalties (many weights stay
exactly zero).  A slice that the weights have not seen sets the temperature of the softmax.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import map_batches, mixed, remainder, table
from marlstone.llm.labels import share

COLUMNS_BITS = 16
COLUMNS = 1 << COLUMNS_BITS
# The weights see at most about so many documents of each language; one in CALIBRATE_ONE_IN sets the temperature.
DOCS_PER_LANGUAGE = 1000
CALIBRATE_ONE_IN = 5
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
SEED = 8
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the character n-grams of a text and how often each occurs."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    runs = [codes]
    for n in (2, 3):
        if len(codes) >= n:
            runs.append((runs[-1][:-1] << np.uint64(21)) | codes[n - 1:])
    hashed = np.concatenate([run * np.uint64(2 * n + 1) for n, run in enumerate(runs, 1)])
    at = (mixed(hashed) >> np.uint64(64 - COLUMNS_BITS)).astype(np.int64)
    if len(at) < 2000:
        return np.unique(at, return_counts=True)
    counts = np.bincount(at, minlength=COLUMNS)
    columns = np.flatnonzero(counts)
    return columns, counts[columns]


def weighted(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    columns, counts = grams(text)
    x = np.log1p(counts) * idf[columns]
    return columns, x / max(np.sqrt((x * x).sum()), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # columns x languages, sparse in value
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, text: str) -> np.ndarray:
        columns, x = weighted(text, self.idf)
        return x @ self.weights[columns] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its probability; a text without a letter is of unknown language."""
        if text is None or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 1.0
        p = softmax(self.logits(text) / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


class Ftrl:
    """FTRL-proximal with one accumulator per column and class; weights follow from it lazily."""

    def __init__(self, classes: int):
        self.z = np.zeros((COLUMNS, classes))
        self.n = np.zeros((COLUMNS, classes))

    def weights(self, columns=slice(None)) -> np.ndarray:
        z, n = self.z[columns], self.n[columns]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def update(self, columns: np.ndarray, x: np.ndarray, error: np.ndarray, w: np.ndarray) -> None:
        gradient = x[:, None] * error
        squared = gradient * gradient
        n = self.n[columns]
        self.z[columns] += gradient - (np.sqrt(n + squared) - np.sqrt(n)) / ALPHA * w
        self.n[columns] = n + squared


def fit(samples: list[tuple[int, np.ndarray, np.ndarray]], classes: int, seed: int = SEED):
    """Weights and bias from (class, columns, values), in a fixed shuffled order."""
    ftrl, bias = Ftrl(classes), np.zeros(classes)
    draw = np.random.default_rng(seed)
    for epoch in range(EPOCHS):
        for i in draw.permutation(len(samples)):
            y, columns, x = samples[i]
            w = ftrl.weights(columns)
            error = softmax(x @ w + bias)
            error[y] -= 1
            ftrl.update(columns, x, error, w)
            bias -= 0.05 / (1 + epoch) * error
    return ftrl.weights(), bias


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, on a grid of powers."""
    if not len(y):
        return 1.0
    grid = 2.0 ** np.arange(-6, 3.01, 0.125)
    loss = [-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each column occurs, and the number of documents; COLUMNS numbers per task."""
    def count(batches):
        seen, n = np.zeros(COLUMNS, np.int64), 0
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                for text in batch.column(0).slice(i, 64).to_pylist():
                    seen[grams(text)[0]] += 1
                    n += 1
        if n:
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_pydict({"at": np.append(at, -1), "n": np.append(seen[at], n)})

    rows = texts.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(COLUMNS), 0
    for r in rows:
        if r["at"] < 0:
            n = r["n"]
        else:
            df[r["at"]] = r["n"]
    return df, n


def train_language_id(
    docs: DataFrame, learn, ident: str = "doc_id", text: str = "text", lang: str = "lang",
) -> LanguageModel:
    """Learn from rows with a text and a language for which ``learn`` (a condition on doc_id) holds."""
    rows = docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & learn)
    there = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(there)
    model = LanguageModel(languages, np.zeros(COLUMNS), np.zeros((COLUMNS, len(languages))), np.zeros(len(languages)))
    if not languages:
        return model
    df, n = document_frequencies(rows)
    model.idf = np.log((1 + n) / (1 + df)) + 1
    chosen = F.lit(False)
    for name in languages:
        fraction = min(1.0, DOCS_PER_LANGUAGE / there[name])
        chosen = chosen | ((F.col("lang") == name) & share(F.col("doc_id"), fraction, SEED))

    def make():
        idf = model.idf

        def work(batch):
            found = [weighted(t, idf) for i in range(0, batch.num_rows, 64)
                     for t in batch.column(1).slice(i, 64).to_pylist()]
            return {"doc_id": batch.column(0), "lang": batch.column(2),
                    "at": pa.array([c.astype("<u2").tobytes() for c, _ in found], pa.binary()),
                    "x": pa.array([x.astype("<f4").tobytes() for _, x in found], pa.binary())}

        return work

    kind = docs.schema[ident].dataType.simpleString()
    vectors = map_batches(rows.where(chosen), f"doc_id {kind}, lang string, at binary, x binary", make)
    number = {name: k for k, name in enumerate(languages)}
    samples = sorted(((str(r["doc_id"]), number[r["lang"]], bytes(r["at"]), bytes(r["x"])) for r in vectors.collect()))
    samples = [(y, np.frombuffer(at, "<u2").astype(np.int64), np.frombuffer(x, "<f4").astype(float))
               for _, y, at, x in samples]
    fitted = [s for i, s in enumerate(samples) if i % CALIBRATE_ONE_IN]
    held = [s for i, s in enumerate(samples) if i % CALIBRATE_ONE_IN == 0]
    model.weights, model.bias = fit(fitted, len(languages))
    logits = np.array([x @ model.weights[at] + model.bias for _, at, x in held]).reshape(len(held), len(languages))
    model.temperature = fit_temperature(logits, np.array([y for y, _, _ in held], int))
    return model


def language_id(docs: DataFrame, model: LanguageModel, carry: list[str] | None = None, text: str = "text") -> DataFrame:
    """``row`` (the columns ``carry``, else all, as one struct), ``lang_pred`` and ``score``.

    ``und`` with score 1 for a null text, an empty one and one without letters (or if no language was
    learned).  Equal texts get equal results, an empty table no rows; extra columns of any name only
    travel in ``row``.
    """
    rows = docs.select(F.struct(*(carry or ["*"])).alias("row"), F.col(text).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))  # COLUMNS rows, one number per language

    def make():
        known = LanguageModel(*sent.value)

        def work(batch):
            texts = batch.column("text")
            found = [known.predict(t) for i in range(0, batch.num_rows, 64) for t in texts.slice(i, 64).to_pylist()]
            return {"row": batch.column("row"), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

        return work

    return map_batches(rows, f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double", make)


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_language_id(docs, remainder(F.col("doc_id"), 4) != 2)
    ident = F.col("row.doc_id")
    return language_id(docs, model, ["doc_id"]).select(
        ident.alias("doc_id"), (remainder(ident, 4) == 2).alias("held_out"), "lang_pred", "score")
