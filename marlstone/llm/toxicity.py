"""Toxicity from two class-conditional Kneser-Ney models.

Each model predicts a word byte by byte from up to seven bytes before (with marks for both
ends of the word), from the counts of its own class.  What a class has not seen, it takes from
backoff counts that both classes share: in how many different contexts a run of five bytes occurs, of four, and so
on.  So an expression that is rare in both classes weighs little, and an unknown form of a toxic
stem still weighs much.  A word's evidence is the difference of its two log-likelihoods.  A text is measured by
the mean over all its words (the length-normalised difference), by its worst windows, and by its
strongest distinct words: how strong they are and how many, among how many.  A logistic fit turns the
measures into a probability.

All labelled training rows are counted, in tables with the full byte runs as keys that grow with the corpus.  The
fit measures a bounded sample of the same rows, each without its own counts.  Tasks get the log ratios
as sorted arrays up to ``MODEL_ENTRIES``; beyond that the words of the documents are joined with them instead.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import ascii_words, forget_kept, map_batches, release, remainder, stored, table, tag
from marlstone.llm.labels import fit_logistic, labelled_texts, share

# Bytes of a run (the last one is predicted), and of the longest shared run.
ORDER, SHARED_ORDER = 8, 5
DISCOUNT = 0.9
# Words in the windows whose worst place counts besides the whole text.
WINDOWS = (32, 4)
# Numbers of strongest distinct words that are averaged, and strengths above which they are counted.
STRONGEST, ABOVE = (1, 2, 3, 5, 8, 16), (1, 2, 4, 6, 8)
MEASURES = 1 + len(WINDOWS) + len(STRONGEST) + 1 + len(ABOVE)
# Entries (12 bytes each) up to which tasks hold the log ratios themselves.
MODEL_ENTRIES = 12_000_000
# The fit sees at most about so many labelled rows with texts of at most so many characters.
CALIBRATION_ROWS, CALIBRATION_CHARACTERS = 3_000, 50_000
CUT = 0.7
SEED = 4


def gram_keys(words: list[bytes]):
    """For every byte of every word and its end mark: the run of bytes up to it as one integer.

    Returns the integers and where each word begins among them.
    """
    framed = b"".join([b"\x01" + w + b"\x02" for w in words])
    raw = np.frombuffer(framed, np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(raw)) - np.repeat(starts, lengths)
    keys = raw.copy()
    for back in range(1, ORDER):
        older = np.zeros_like(raw)
        older[back:] = raw[:-back]
        older[place < back] = 0
        keys |= older << np.uint64(8 * back)
    return keys[place > 0].view(np.int64), starts - np.arange(len(words))


def contexts_of(keys: np.ndarray) -> np.ndarray:
    """The runs without their last byte."""
    return (keys.view(np.uint64) >> np.uint64(8)).view(np.int64)


@dataclass
class Ratios:
    """Log ratios by key, sorted: of seen runs, and of any unseen byte after a context."""

    keys: np.ndarray
    gram: np.ndarray
    contexts: np.ndarray
    rest: np.ndarray

    @staticmethod
    def _found(keys: np.ndarray, sorted_keys: np.ndarray):
        if not len(sorted_keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
        return at, sorted_keys[at] == keys

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """Difference of the log-likelihoods of each word."""
        keys, starts = gram_keys(words)
        distinct, back = np.unique(keys, return_inverse=True)
        at, known = self._found(distinct, self.keys)
        scores = np.zeros(len(distinct))
        scores[known] = self.gram[at[known]]
        at, known_context = self._found(contexts_of(distinct[~known]), self.contexts)
        others = np.zeros(len(at))
        others[known_context] = self.rest[at[known_context]]
        scores[~known] = others
        return np.add.reduceat(scores[back], starts)


def evidence(words: list[bytes], score_of: dict[bytes, float]) -> list[float]:
    """The measures of one text; all zero without words.  Every occurrence of a word counts in the mean and the windows."""
    if not words:
        return [0.0] * MEASURES
    scores = np.fromiter(map(score_of.__getitem__, words), float, len(words))
    run = np.concatenate([[0.0], scores.cumsum()])
    found = [run[-1] / len(words)]
    for size in WINDOWS:
        width = min(size, len(words))
        found.append((run[width:] - run[:-width]).max() / size)
    distinct = set(words)
    values = np.fromiter(map(score_of.__getitem__, distinct), float, len(distinct))
    most = STRONGEST[-1]
    top = np.sort(np.partition(values, len(values) - most)[-most:] if len(values) > most else values)[::-1]
    so_far = np.concatenate([top, np.zeros(most - len(top))]).cumsum()
    found += [so_far[k - 1] / k for k in STRONGEST]
    found.append(np.log(len(values) + 1))
    return found + [np.log1p((values > t).sum()) for t in ABOVE]


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, toxic, ordinary) over (text, label) rows; counted within tasks before the shuffle."""
    def count(batches):
        forget_kept()
        counts = {0: Counter(), 1: Counter()}

        def flush():
            for label, c in counts.items():
                if c:
                    n = np.fromiter(c.values(), np.int64, len(c))
                    zero = np.zeros_like(n)
                    yield pa.RecordBatch.from_pydict({
                        "word": pa.array(list(c), pa.binary()), "toxic": n if label else zero,
                        "ordinary": zero if label else n})
                    c.clear()

        for batch in batches:
            texts_, labels = batch.column(0), batch.column(1).to_pylist()
            for i in range(0, len(labels), 64):
                for text, label in zip(texts_.slice(i, 64).to_pylist(), labels[i:i + 64]):
                    counts[int(label == 1)].update(ascii_words(text))
                if len(counts[0]) + len(counts[1]) > 300_000:
                    yield from flush()
        yield from flush()
        batch = texts_ = None
        release()

    rows = texts.select("text", "label").mapInArrow(count, "word binary, toxic long, ordinary long")
    return rows.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _grams(words: DataFrame) -> DataFrame:
    """(key, toxic, ordinary) of the runs of bytes in the counted words, summed within batches."""
    def make():
        def work(batch):
            toxic = np.asarray(batch.column(1), np.int64)
            ordinary = np.asarray(batch.column(2), np.int64)
            keys, starts = gram_keys(batch.column(0).to_pylist())
            lengths = np.diff(np.append(starts, len(keys)))
            unique, back = np.unique(keys, return_inverse=True)
            total = lambda n: np.bincount(back, np.repeat(n, lengths), len(unique)).astype(np.int64)
            return {"key": unique, "toxic": total(toxic), "ordinary": total(ordinary)}

        return work

    return map_batches(words, "key long, toxic long, ordinary long", make)


def _suffix(key: Column | str, n: int) -> Column:
    """The last ``n`` bytes of a run."""
    return (F.col(key) if isinstance(key, str) else key).bitwiseAND(F.lit((1 << 8 * n) - 1))


def _context(key: Column | str = "key") -> Column:
    return F.shiftrightunsigned(key, 8)


def short_backoff(words: DataFrame, discount: float = DISCOUNT) -> tuple[np.ndarray, np.ndarray]:
    """Runs of up to three bytes and the probability of their last byte, from how many longer runs each one ends.

    There are at most 2**24 of them, however many texts: they fit the driver and a broadcast.
    """
    def make():
        def work(batch):
            keys = gram_keys(batch.column(0).to_pylist())[0]
            return {"key": np.unique(keys & np.int64(0xFFFFFFFF))}

        return work

    four = map_batches(words.select("word"), "key long", make).distinct()
    counted = four.groupBy(_suffix("key", 3).alias("key")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    keys, n = counted.column("key").to_numpy(), counted.column("n").to_numpy().astype(float)
    levels = [(keys, n)]
    for order in (2, 1):
        keys, n = np.unique(levels[-1][0] & ((1 << 8 * order) - 1), return_counts=True)
        levels.append((keys, n.astype(float)))
    known, p = np.empty(0, np.int64), np.empty(0)
    for length, (keys, n) in enumerate(reversed(levels), 1):
        _, group = np.unique(keys >> 8, return_inverse=True)
        total, kinds = np.bincount(group, n), np.bincount(group)
        lower = p[np.searchsorted(known, keys & ((1 << 8 * (length - 1)) - 1))] if length > 1 else 1 / 256
        order = np.argsort(keys)
        known = keys[order]
        p = ((np.maximum(n - discount, 0) + discount * kinds[group] * lower) / total[group])[order]
    return known, p


def run_table(words: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """Every run of bytes with all that its probabilities need; written once.

    Counts by class, the shared probability of its last byte, and of its context the totals and the numbers of
    different bytes by class; ``first`` marks one run of each context.  Contexts and the suffixes of four and five
    bytes are all decided by the three bytes before the last one, so one shuffle by these serves them all.
    """
    spark = words.sparkSession
    keys, p = short_backoff(words, discount)
    short = spark.createDataFrame(pa.table({"short": pa.array(keys, pa.int64()), "lower": pa.array(p, pa.float64())}))
    placed = _grams(words).withColumn("place", _suffix(_context(), 3)).repartition("place")
    grams = placed.groupBy("place", "key").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    grams = grams.withColumns({
        "context": _context(), "short": _suffix("key", 3), "end4": _suffix("key", 4), "end5": _suffix("key", 5),
        "before5": _suffix(_context(), 4), "last": _suffix("key", 1)})

    def over(*columns):
        return Window.partitionBy("place", *columns)

    def kinds(column, *columns):
        return F.size(F.collect_set(column).over(over(*columns)))

    one = F.lit(1)
    counted = grams.withColumns({
        "n5": F.count(one).over(over("end5")), "total5": F.count(one).over(over("before5")),
        "kinds5": kinds("last", "before5"),
        # Different runs of five bytes that end in these four, or go on after these three.
        "n4": kinds("end5", "end4"), "total4": kinds("end5"), "kinds4": kinds("last"),
        "toxic_total": F.sum("toxic").over(over("context")), "ordinary_total": F.sum("ordinary").over(over("context")),
        "toxic_kinds": F.count(F.when(F.col("toxic") > 0, 1)).over(over("context")),
        "ordinary_kinds": F.count(F.when(F.col("ordinary") > 0, 1)).over(over("context")),
        "first": F.row_number().over(over("context").orderBy("key")) == 1,
    })

    def smoothed(n, lower):
        return (F.greatest(F.col(f"n{n}") - discount, F.lit(0.0)) + discount * F.col(f"kinds{n}") * lower) / F.col(f"total{n}")

    shared = smoothed(5, smoothed(4, F.col("lower")))
    # At most 2**24 rows.
    return stored(counted.join(F.broadcast(short), "short").select(
        "key", "toxic", "ordinary", shared.cast("float").alias("shared"), "toxic_total", "ordinary_total",
        "toxic_kinds", "ordinary_kinds", "first"), "toxicity-runs")


def log_ratios(runs: DataFrame, discount: float = DISCOUNT) -> tuple[DataFrame, DataFrame]:
    """(key, ratio) of seen runs and (key, ratio) of contexts for bytes neither class has seen there."""
    def rest(name):
        # A context that the class never saw passes everything on to the shared counts.
        total = F.col(f"{name}_total")
        return F.when(total > 0, discount * F.col(f"{name}_kinds") / total).otherwise(1.0)

    def probability(name):
        total = F.col(f"{name}_total")
        own = F.when(total > 0, F.greatest(F.col(name) - discount, F.lit(0.0)) / total).otherwise(0.0)
        return own + rest(name) * F.col("shared")

    gram = runs.select("key", F.log(probability("toxic") / probability("ordinary")).cast("float").alias("ratio"))
    context = runs.where("first").select(
        _context().alias("key"), F.log(rest("toxic") / rest("ordinary")).cast("float").alias("ratio"))
    return gram, context


@dataclass
class ToxicityModel:
    gram: DataFrame       # key, ratio
    context: DataFrame    # key, ratio
    weights: np.ndarray   # of 1 and the measures
    entries: int

    def ratios(self) -> Ratios:
        def sorted_arrays(rows):
            found = rows.toArrow()
            keys = found.column("key").to_numpy()
            order = np.argsort(keys)
            return keys[order], found.column("ratio").to_numpy()[order]

        return Ratios(*sorted_arrays(self.gram), *sorted_arrays(self.context))


class Counts:
    """Counts of the runs in a sample of texts, to measure a text as if it had not been counted."""

    def __init__(self, columns: dict[str, np.ndarray], discount: float = DISCOUNT):
        """``columns`` are those of ``sorted_columns``: narrow, and shared by all texts of a task."""
        vars(self).update(columns)
        self.discount = discount

    @staticmethod
    def sorted_columns(runs: DataFrame) -> dict[str, np.ndarray]:
        found = runs.select("key", "shared", *[F.col(c).cast("int") for c in (
            "toxic", "ordinary", "toxic_total", "ordinary_total", "toxic_kinds", "ordinary_kinds")]).toArrow()
        order = np.argsort(found.column("key").to_numpy())
        return {("keys" if n == "key" else n): found.column(n).to_numpy()[order] for n in found.column_names}

    def without(self, words: list[bytes], label: int) -> list[float]:
        """The measures of a counted text, its own counts taken away."""
        if not words:
            return evidence(words, {})
        times = Counter(words)
        distinct = list(times)
        keys, starts = gram_keys(distinct)
        lengths = np.diff(np.append(starts, len(keys)))
        own_keys, back = np.unique(keys, return_inverse=True)
        own = np.bincount(back, np.repeat(np.fromiter(times.values(), float, len(times)), lengths), len(own_keys))
        at = np.searchsorted(self.keys, own_keys)
        group = np.unique(contexts_of(own_keys), return_inverse=True)[1]
        logs = []
        for mine, count, total, kinds in (
            (label == 1, self.toxic, self.toxic_total, self.toxic_kinds),
            (label != 1, self.ordinary, self.ordinary_total, self.ordinary_kinds),
        ):
            n, all_, different = (column[at].astype(float) for column in (count, total, kinds))
            if mine:
                gone = (n == own).astype(float)
                all_ = all_ - np.bincount(group, own)[group]
                different = different - np.bincount(group, gone)[group]
                n = n - own
            seen, safe = all_ > 0, np.maximum(all_, 1)
            rest = np.where(seen, self.discount * different / safe, 1.0)
            logs.append(np.log(np.where(seen, np.maximum(n - self.discount, 0) / safe, 0) + rest * self.shared[at]))
        scores = np.add.reduceat((logs[0] - logs[1])[back], starts)
        return evidence(words, dict(zip(distinct, scores.tolist())))


def _sample_measures(sample: DataFrame, runs: DataFrame) -> list:
    """(label, measures without own counts) of the sampled rows."""
    def make_keys():
        def work(batch):
            words = set().union(*[set(ascii_words(t)) for t in batch.column("text").to_pylist()])
            return {"key": np.unique(gram_keys(list(words))[0]) if words else np.empty(0, np.int64)}

        return work

    keys = map_batches(sample.select("text"), "key long", make_keys).distinct()
    # What is sent is bounded by the sample, and the sample by its rows and characters.
    sent = sample.sparkSession.sparkContext.broadcast(Counts.sorted_columns(runs.join(keys, "key", "left_semi")))

    def make():
        counts = Counts(sent.value)

        def work(batch):
            labels = batch.column("label").to_pylist()
            x = [counts.without(ascii_words(t), y) for t, y in zip(batch.column("text").to_pylist(), labels)]
            return {"doc_id": batch.column("doc_id"), "label": labels, "x": x}

        return work

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = map_batches(sample.select("doc_id", "label", "text"), f"doc_id {kind}, label int, x array<double>", make)
    found = rows.orderBy("doc_id").collect()
    sent.destroy()
    return found


def train_toxicity(docs: DataFrame, labels: DataFrame, learn, label: str = "toxic") -> ToxicityModel:
    """Count all labelled rows for which ``learn`` (a condition on doc_id) holds; fit on a bounded sample of them.

    Without labelled rows, or with one class only, the model says 0 for every text.
    """
    words = stored(word_counts(labelled_texts(docs, labels, label, learn)), "toxicity-words")
    if words.isEmpty():
        none = docs.sparkSession.createDataFrame([], "key long, ratio float")
        return ToxicityModel(none, none, np.array([-20.0] + [0.0] * MEASURES), 0)
    runs = run_table(words)
    gram, context = log_ratios(runs)
    model = ToxicityModel(gram, context, np.array([-20.0] + [0.0] * MEASURES), 2 * runs.count())
    there = labels.where(F.col(label).isNotNull() & learn).count()
    few = share(F.col("doc_id"), min(1.0, CALIBRATION_ROWS / max(there, 1)), SEED + 1)
    sample = labelled_texts(docs, labels, label, learn & few).where(F.length("text") <= CALIBRATION_CHARACTERS)
    rows = _sample_measures(stored(sample, "toxicity-sample"), runs)
    y = np.array([r["label"] == 1 for r in rows], float)
    if 0 < y.sum() < len(y):
        x = np.array([r["x"] for r in rows])
        spread = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
        weights = fit_logistic(np.column_stack([np.ones(len(y)), x / spread]), y, 1e-4, np.array([0.0] + [1.0] * MEASURES))
        model.weights = weights / np.concatenate([[1.0], spread])
    return model


def measured(rows: DataFrame, model: ToxicityModel, entries: int = MODEL_ENTRIES) -> DataFrame:
    """``rows`` (which must have a column ``text``) with ``x``, the measures of its evidence."""
    return _measured_in_tasks(rows, model) if model.entries <= entries else _measured_by_joins(rows, model)


def _with_measures(rows: DataFrame, make_scores, inputs: tuple[str, ...] = ("text",)) -> DataFrame:
    kept = [c for c in rows.columns if c not in inputs]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept) + ", x array<double>"

    def make():
        forget_kept()
        scores = make_scores()

        def work(batch):
            x: list = []
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                words = [ascii_words(t) for t in part.column("text").to_pylist()]
                x += [evidence(w, s) for w, s in zip(words, scores(words, part))]
            return {c: batch.column(c) for c in kept} | {"x": x}

        return work

    return map_batches(rows, schema, make)


def _measured_in_tasks(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """Tasks hold the ratios, at most ``MODEL_ENTRIES`` of them."""
    sent = rows.sparkSession.sparkContext.broadcast(tuple(vars(model.ratios()).values()))

    def make():
        ratios, memo = Ratios(*sent.value), {}

        def scores(words, _):
            wanted = set().union(*words)
            missing = [w for w in wanted if w not in memo]
            if len(memo) + len(missing) > 100_000:
                memo.clear()
                missing = list(wanted)
            if missing:
                memo.update(zip(missing, ratios.word_scores(missing).tolist()))
            return [memo] * len(words)

        return scores

    return _with_measures(rows, make)


def word_scores(words: DataFrame, model: ToxicityModel) -> DataFrame:
    """(word, score) of distinct words by joining their runs with the ratios."""
    def make():
        def work(batch):
            words_ = batch.column("word")
            keys, starts = gram_keys(words_.to_pylist())
            lengths = np.diff(np.append(starts, len(keys)))
            return {"word": words_.take(pa.array(np.repeat(np.arange(len(words_)), lengths))), "key": keys}

        return work

    # A run that many words share is counted per word only after the joins; its ratio is one row.
    each = map_batches(words, "word binary, key long", make)
    seen = each.join(model.gram, "key", "left").withColumn("context", _context())
    rest = model.context.select(F.col("key").alias("context"), F.col("ratio").alias("rest"))
    return seen.join(rest, "context", "left").groupBy("word").agg(
        F.sum(F.coalesce("ratio", "rest", F.lit(0.0))).alias("score"))


def _measured_by_joins(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """The distinct words of each row get their scores by a join on the word, whatever the size of the model."""
    ident, words, found = tag("row"), tag("words"), tag("scores")
    numbered = stored(rows.withColumn(ident, F.monotonically_increasing_id()), "toxicity-rows")

    def make():
        def work(batch):
            texts = [list(dict.fromkeys(ascii_words(t))) for t in batch.column("text").to_pylist()]
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            return {ident: np.repeat(np.asarray(batch.column(ident), np.int64), lengths),
                    "word": pa.array([w for t in texts for w in t], pa.binary())}

        return work

    each = map_batches(numbered.select(ident, "text"), f"{ident} long, word binary", make)
    scored = stored(word_scores(each.select("word").distinct(), model), "toxicity-words")
    per_row = each.join(scored, "word").groupBy(ident).agg(
        F.collect_list(F.struct("word", "score")).alias(found))
    joined = numbered.join(per_row, ident, "left").drop(ident)
    flat = joined.withColumns({words: F.col(f"{found}.word"), found: F.col(f"{found}.score")})

    def make_scores():
        def scores(_, part):
            return [dict(zip(w or (), s or ())) for w, s in zip(
                part.column(words).to_pylist(), part.column(found).to_pylist())]

        return scores

    return _with_measures(flat, make_scores, ("text", words, found))


def toxicity(docs: DataFrame, model: ToxicityModel, carry: list[str] | None = None, text: str = "text") -> DataFrame:
    """``row`` (the columns ``carry``, else all, as one struct), ``score`` and ``predicted``.

    A null text counts as empty; an empty text has no evidence and gets the score of none.  Rows are
    scored one by one, so repeated rows get equal scores and an empty table no rows; texts of any length are
    scored whole.  Extra columns of any name only travel in ``row``.
    """
    rows = docs.select(F.struct(*(carry or ["*"])).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bias, *weights = (float(w) for w in model.weights)
    logit = F.lit(bias)
    for k, weight in enumerate(weights):
        logit = logit + F.lit(weight) * F.col("x")[k]
    return measured(rows, model).select("row", (1 / (1 + F.exp(-logit))).alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))


def learnable():
    """The rows whose labels may be seen: crc32(doc_id) mod 3 is not 1."""
    return remainder(F.col("doc_id"), 3) != 1


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_toxicity(docs, table(spark, sf_dir, "labels"), learnable())
    ident = F.col("row.doc_id")
    return toxicity(docs, model, ["doc_id"]).select(
        ident.alias("doc_id"), (remainder(ident, 3) == 1).alias("held_out"), "score", "predicted")
