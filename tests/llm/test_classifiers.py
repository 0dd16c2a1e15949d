import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm import common, language_id, quality_rank, toxicity
from marlstone.llm.common import remainder

EDGE = [(9001, None), (9002, ""), (9003, "  \n"), (9004, "word"), (9005, "12 34 !"), (None, "no id here")]
CLASHING = ["score", "predicted", "row", "x", "text_hash", "lang_pred"]


def test_remainder(spark, documents):
    rows = documents([(i, "") for i in [0, 7, 12, 123456789]]).select("doc_id", remainder(F.col("doc_id"), 4).alias("r"))
    assert all(r.r == zlib.crc32(str(r.doc_id).encode()) % 4 for r in rows.collect())


def labelled(spark, prose, spoil, n=240):
    """Every fourth text is spoilt; labels of the spoilt and the others."""
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(i, 60)
        rows.append((i, spoil(text, i) if bad else text))
        labels.append((i, int(not bad), int(bad)))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def insulted(text, seed):
    words, draw = text.split(), random.Random(seed)
    for _ in range(5):
        words.insert(draw.randrange(len(words)), "zuqq" + draw.choice(["a", "on", "erie", "ist", "lo", "umb", "eck"]))
    return " ".join(words)


def test_toxicity_finds_held_out_rows(spark, documents, prose):
    rows, labels = labelled(spark, prose, insulted)
    docs = documents(rows + EDGE, CLASHING)
    model = toxicity.train_toxicity(docs, labels, toxicity.learnable())
    got = toxicity.toxicity(docs, model)
    held = {r.doc_id: r.predicted for r in got.select("row.doc_id", "score", "predicted").collect()
            if r.doc_id is not None and r.doc_id < 9000 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert np.mean([held[k] == int(k % 4 == 0) for k in held]) > 0.95
    assert got.count() == len(rows) + len(EDGE) and got.where("score is null or score < 0 or score > 1").isEmpty()
    assert got.select("row.*").columns == docs.columns


def as_runs(word):
    framed = b"\x01" + word + b"\x02"
    return [framed[max(0, i - toxicity.ORDER + 1):i + 1] for i in range(1, len(framed))]


class PlainKneserNey:
    """The formulas written out over dictionaries."""

    def __init__(self, counts):
        self.grams = {}
        for word, pair in counts.items():
            for g in as_runs(word):
                n = self.grams.setdefault(g, [0, 0])
                n[0] += pair[0]
                n[1] += pair[1]
        self.levels, runs = {}, set(self.grams)
        for order in range(toxicity.SHARED_ORDER, 0, -1):
            level = {}
            for g in runs:
                level[g[-order:]] = level.get(g[-order:], 0) + 1
            self.levels[order], runs = level, set(level)

    def shared(self, g, order):
        if not order:
            return 1 / 256
        level, g = self.levels[order], g[-order:]
        after = [n for h, n in level.items() if h[:-1] == g[:-1]]
        lower = self.shared(g, order - 1)
        d = toxicity.DISCOUNT
        return (max(level.get(g, 0) - d, 0) + d * len(after) * lower) / sum(after) if after else lower

    def probability(self, g, label, own=()):
        """Of the last byte of ``g``; ``own`` are the runs of a text of this class that does not count."""
        left = {h: n[label] - sum(h == o for o in own) for h, n in self.grams.items() if h[:-1] == g[:-1]}
        total, kinds, d = sum(left.values()), sum(n > 0 for n in left.values()), toxicity.DISCOUNT
        shared = self.shared(g, toxicity.SHARED_ORDER)
        return max(left.get(g, 0) - d, 0) / total + d * kinds / total * shared if total else shared

    def score(self, word, own=((), ())):
        return sum(np.log(self.probability(g, 0, own[0]) / self.probability(g, 1, own[1])) for g in as_runs(word))


def model_of(spark, counts):
    words = spark.createDataFrame([(w, *n) for w, n in counts.items()], "word binary, toxic long, ordinary long")
    runs = toxicity.run_table(words.repartition(3))
    gram, context = toxicity.log_ratios(runs)
    return runs, toxicity.ToxicityModel(gram, context, np.zeros(1 + toxicity.MEASURES), 0)


def some_words(seed, n):
    draw = random.Random(seed)
    return {"".join(draw.choice("abcé") for _ in range(draw.randint(1, 12))).encode(): (draw.randint(0, 3), draw.randint(0, 5))
            for _ in range(n)}


def test_toxicity_ratios_are_kneser_ney(spark):
    counts = {w: n for w, n in some_words(1, 60).items() if sum(n)}
    _, model = model_of(spark, counts)
    plain, ratios = PlainKneserNey(counts), model.ratios()
    wanted = [*counts, *list(some_words(2, 30)), b"zzz", b"ab" * 40]
    expected = [plain.score(w) for w in wanted]
    assert np.allclose(ratios.word_scores(wanted), expected, atol=1e-4)
    joined = {bytes(r.word): r.score for r in toxicity.word_scores(
        spark.createDataFrame([(w,) for w in set(wanted)], "word binary"), model).collect()}
    assert np.allclose([joined[w] for w in wanted], expected, atol=1e-4)


def test_a_sampled_text_is_measured_without_its_own_counts(spark):
    counts = {w: n for w, n in some_words(3, 40).items() if sum(n)}
    text = [w for w, n in counts.items() if n[0]][:5]
    runs, _ = model_of(spark, counts)
    known = toxicity.Counts(toxicity.Counts.sorted_columns(runs))
    own = [g for w in text for g in as_runs(w)]
    plain = PlainKneserNey(counts)
    expected = toxicity.evidence(text, {w: plain.score(w, (own, ())) for w in text})
    assert np.allclose(known.without(text, 1), expected, atol=1e-4)


def test_evidence_written_out():
    draw = random.Random(5)
    score = {bytes([c]): draw.uniform(-3, 9) for c in range(97, 117)}
    for n in (1, 3, 10, 90):
        words = [draw.choice(list(score)) for _ in range(n)]
        values = [score[w] for w in words]
        strongest = sorted((score[w] for w in set(words)), reverse=True)
        expected = [sum(values) / n]
        for size in toxicity.WINDOWS:
            width = min(size, n)
            expected.append(max(sum(values[i:i + width]) for i in range(n - width + 1)) / size)
        expected += [sum(strongest[:k]) / k for k in toxicity.STRONGEST] + [np.log(len(strongest) + 1)]
        expected += [np.log1p(sum(v > t for v in strongest)) for t in toxicity.ABOVE]
        assert np.allclose(toxicity.evidence(words, score), expected)
    # A dense passage counts although the words stood in the text before.
    quiet = [b"x"] * 200
    score |= {b"x": -1.0, b"bad": 9.0}
    assert toxicity.evidence(quiet + [b"bad"] * 60, score)[0] > toxicity.evidence(quiet + [b"bad"], score)[0]


def test_both_ways_to_measure_agree(spark, documents, prose):
    rows, labels = labelled(spark, prose, insulted, 120)
    rows += [(9001, None), (9002, ""), (9003, "same " * 5000), (9003, "same " * 5000)]
    docs = documents(rows, CLASHING)
    model = toxicity.train_toxicity(docs, labels, F.lit(True))
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    held, joined = (sorted((r.doc_id, [round(v, 3) for v in r.x]) for r in toxicity.measured(source, model, n).collect())
                    for n in (10**9, 0))
    assert held == joined and len(held) == len(rows)


STEMS = {"abcdefgh": "zuqq", "éèêàùçôî": "ôçéù", "абвгдежз": "жзгд", "漢字仮名交文書": "名文漢字"}


def test_unknown_forms_of_a_stem_in_four_scripts(spark, documents):
    rows, labels = [], []
    for k, (letters, stem) in enumerate(STEMS.items()):
        for i in range(90):
            draw = random.Random(f"{k}-{i}")
            words = ["".join(draw.choice(letters) for _ in range(draw.randint(2, 6))) for _ in range(60)]
            bad = i % 5 == 0
            if bad:
                for _ in range(4):
                    words[draw.randrange(60)] = stem + "".join(draw.choice(letters) for _ in range(draw.randint(2, 4)))
            rows.append((1000 * k + i, " ".join(words)))
            labels.append((1000 * k + i, 1, int(bad)))
    docs = documents(rows)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train_toxicity(docs, known, toxicity.learnable())
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, model).select("row.doc_id", "predicted").collect()}
    for k in range(4):
        held = [(i, bad) for i, _, bad in labels if i // 1000 == k and zlib.crc32(str(i).encode()) % 3 == 1]
        assert sum(got[i] == bad for i, bad in held) >= 0.9 * len(held)
        assert sum(got[i] for i, bad in held if bad) >= 0.7 * sum(bad for _, bad in held)


def shouted(text, seed):
    return [text.upper().replace(" ", "!! "), text.replace(" ", " | "), "same words " * 60][seed // 4 % 3]


def test_quality_finds_held_out_rows(spark, documents, prose):
    rows, labels = labelled(spark, prose, shouted)
    docs = documents(rows + EDGE, CLASHING)
    model = quality_rank.train_quality(docs, labels, remainder(F.col("doc_id"), 4) != 2)
    got = quality_rank.quality_rank(docs, model)
    held = {r.doc_id: r.predicted for r in got.select("row.doc_id", "score", "predicted").collect()
            if r.doc_id is not None and r.doc_id < 9000 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([held[k] == int(k % 4 != 0) for k in held]) > 0.95
    assert got.count() == len(rows) + len(EDGE) and got.where("score is null or score < 0 or score > 1").isEmpty()


def test_pairs_rank_and_cut():
    draw = np.random.default_rng(1)
    y = (draw.random(400) < 0.7).astype(int)
    x = draw.normal(size=(400, len(quality_rank.MEASURES))) + 2.5 * y[:, None] * (np.arange(len(quality_rank.MEASURES)) < 2)
    model = quality_rank.fit_pairs(x, y)
    strengths = model.strengths(x)
    assert np.mean((strengths >= np.quantile(strengths, model.level)) == (y == 1)) > 0.97
    assert abs(model.level - (y == 0).mean()) < 0.03


def test_pair_weights_minimise_the_loss_on_differences():
    """Against plain gradient descent on the written-out loss over the same pairs."""
    draw = np.random.default_rng(2)
    n = len(quality_rank.MEASURES)
    y = np.arange(60) % 2
    x = draw.normal(size=(60, n)) + 0.3 * y[:, None]
    model = quality_rank.fit_pairs(x, y, pairs=300, seed=4)
    z = (x - model.mean) / model.scale
    again = np.random.default_rng(4)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y != 1)
    difference = z[again.choice(good, 300)] - z[again.choice(bad, 300)]

    def loss(w):
        return np.mean([np.log1p(np.exp(-float(d @ w))) for d in difference]) + 0.5e-4 * float(w @ w)

    w = np.zeros(n)
    for _ in range(4000):
        p = 1 / (1 + np.exp(difference @ w))
        w -= 0.5 * (-(difference * p[:, None]).mean(axis=0) + 1e-4 * w)
    assert loss(model.weights) <= loss(w) + 1e-6


def test_the_cut_is_a_quantile_of_all_documents(spark):
    values = [float(i * i % 997) for i in range(900)]
    ranked = spark.createDataFrame([(v,) for v in values], "strength double")
    for level in (0.1, 0.5, 0.9):
        cut = quality_rank._cut(ranked, level)
        below = sum(v < cut for v in values)
        assert abs(below / len(values) - level) < 0.01
    assert quality_rank._cut(ranked, 0.0) < min(values) and quality_rank._cut(ranked, 1.0) > max(values)
    assert quality_rank._cut(ranked.limit(0), 0.3) == 0.0


def test_long_and_repeated_texts_get_equal_scores(spark, documents, prose):
    rows, labels = labelled(spark, prose, shouted, 80)
    long = prose(500, 40_000)
    docs = documents([*rows, (9003, long), (9004, long), (9003, long)])
    model = quality_rank.train_quality(docs, labels, F.lit(True))
    got = quality_rank.quality_rank(docs, model, ["doc_id"]).select("row.doc_id", "score").where("doc_id > 9000").collect()
    assert len(got) == 3 and len({r.score for r in got}) == 1


@pytest.mark.parametrize("train", [toxicity.train_toxicity, quality_rank.train_quality])
def test_nothing_to_learn_from(spark, documents, train):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one_class = spark.createDataFrame([(9004, 1, 0), (9005, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    score = toxicity.toxicity if train is toxicity.train_toxicity else quality_rank.quality_rank
    for labels in (none, one_class):
        for docs in (documents([]), documents(EDGE)):
            got = score(docs, train(docs, labels, F.lit(True)))
            assert got.count() == docs.count() and got.where("score is null").isEmpty()


LETTERS = {"aa": "abcde", "bb": "acefg", "cc": "éüñ漢"}


def in_language(name, seed, n=40):
    draw = random.Random(f"{name}{seed}")
    return " ".join("".join(draw.choice(LETTERS[name]) for _ in range(draw.randint(2, 6))) for _ in range(n))


def test_language_of_held_out_rows(spark, documents):
    rows = [(i, in_language(n, i), n, "s") for i, n in enumerate(list(LETTERS) * 60)]
    rows += [(1000, None, "aa", "s"), (1001, "12 !", "bb", "s"), (1002, "", "cc", "s"), (1003, in_language("bb", 1), None, None)]
    docs = documents(rows, CLASHING)
    model = language_id.train_language_id(docs, remainder(F.col("doc_id"), 4) != 2)
    assert model.languages == sorted(LETTERS) and (model.weights == 0).mean() > 0.5
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.language_id(docs, model).select(
        "row.doc_id", "lang_pred", "score").collect()}
    held = [r for r in rows if r[0] < 1000 and zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert np.mean([got[r[0]][0] == r[2] for r in held]) > 0.95
    assert all(got[k] == ("und", 1.0) for k in (1000, 1001, 1002)) and got[1003][0] == "bb"
    assert all(0 <= s <= 1 for _, s in got.values())


def test_language_without_training_rows(spark, documents):
    docs = documents([(1, "some text", None, None)])
    model = language_id.train_language_id(docs, F.lit(True))
    assert [r.lang_pred for r in language_id.language_id(docs, model).collect()] == ["und"]
    assert language_id.language_id(documents([]), model).count() == 0


def test_ftrl_learns_sparse_weights():
    draw = np.random.default_rng(0)
    samples = [(y, np.sort(draw.choice(500, 20, False)) + 500 * y, np.full(20, 0.22)) for y in draw.integers(0, 2, 200)]
    weights, bias = language_id.fit(samples, 2)
    right = [np.argmax(x @ weights[at] + bias) == y for y, at, x in samples]
    assert np.mean(right) > 0.95 and not weights[1000:].any()


def test_toxicity_tasks_give_up_what_other_operators_keep(spark, monkeypatch):
    class Rows:
        """Takes the function that tasks would run."""

        columns, schema = ["doc_id", "text"], T.StructType().add("doc_id", "long")
        select = groupBy = agg = lambda self, *_: self

        def mapInArrow(self, run, _):
            self.run = run
            return self

    for task in (lambda rows: toxicity.word_counts(rows), lambda rows: toxicity._with_measures(rows, lambda: None)):
        kept = common.per_process(("word_bpe", "other operator"), list)
        assert common.per_process(("word_bpe", "other operator"), list) is kept
        rows = Rows()
        task(rows)
        assert list(rows.run(iter([]))) == []
        assert common.per_process(("word_bpe", "other operator"), list) is not kept
