import re
from collections import Counter

from marlstone.llm import quality_rules as q

CLASHING = ["kept", "n_words", "words", "row", "limits", "value", "rows"]


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def test_counts(spark, documents, prose):
    base = prose(1, 200)
    texts = [None, "", " \n ", "one", base, base + "\n" + base, "a b c d e " * 3, "a a a a a a a", "x\ny\nx\n x\n\n",
             "é ü # | <b> " * 4, base.replace(" ", "\t\n", 50), "w " * 30_000, " ".join(map(str, range(20_000))),
             "a b c d e f a b c d e", "a b c d"]
    got = q.base_counts(documents(list(enumerate(texts)), CLASHING)).select("row.doc_id", *q.COUNTS, "base_failed")
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == {i: counts(t) for i, t in enumerate(texts)}


def test_limits_follow_the_source(spark, documents, prose):
    rows = [(i, prose(i, 60), "en", "plain") for i in range(60)]
    rows += [(100 + i, prose(i, 60).replace(" ", " # ", 25), "en", "code") for i in range(60)]
    rows += [(500, prose(7, 60).replace(" ", " # ", 25), "en", "plain"), (501, None, None, None), (502, "", "fr", "new")]
    got = {r.doc_id: r.kept for r in q.quality_rules(documents(rows, CLASHING), least_rows=20).select(
        "row.doc_id", "kept").collect()}
    assert {k for k, v in got.items() if not v} == {500, 501, 502}


def test_small_source_uses_its_language(spark, documents, prose):
    rows = [(i, prose(i, 60), "en", "large") for i in range(60)]
    rows += [(200, prose(99, 60).replace(" ", " | "), "en", "small"), (201, prose(98, 60), None, "small")]
    got = {r.doc_id: r.kept for r in q.quality_rules(documents(rows), least_rows=20).select("row.doc_id", "kept").collect()}
    assert not got[200] and got[201] and all(got[i] for i in range(60))


def test_rows_are_kept_whole(spark, documents, prose):
    docs = documents([(1, prose(1, 60)), (1, prose(1, 60)), (None, prose(2, 60))], CLASHING)
    assert sorted(map(str, q.quality_rules(docs).select("row.*").collect())) == sorted(map(str, docs.collect()))


def test_empty_table(spark, documents):
    assert q.quality_rules(documents([])).count() == 0


def test_no_python(spark, documents):
    plan = q.quality_rules(documents([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sketches_merge_to_exact_quartiles(spark, documents, prose):
    counted = spark.createDataFrame(
        [("en", f"s{i % 3}", 100, i, i % 7, 0, 0, False) for i in range(400)],
        "lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean")
    row = q.fences(q.sketches(counted), ["lang"]).first()
    cut = lambda v: v >> max(v.bit_length() - 7, 0) << max(v.bit_length() - 7, 0)
    lengths = sorted(cut(10 * i) for i in range(400))
    q1, q3 = lengths[99], lengths[299]
    assert row["rows"] == 400
    assert row["word_length_high"] == q3 + 4 * max(q3 - q1, 500) and row["word_length_low"] == q1 - 4 * max(q3 - q1, 500)
