"""Quality rules with thresholds that follow the data of each language and source.

Every measured ratio is an integer in thousandths.  A sketch is a histogram of such integers
cut to their seven leading bits: it is exact below 128, within 1/64 above, does not depend on
row order, and two sketches merge by adding their counts.  Sources merge into languages and
languages into the whole, so a small source borrows the limits of its language.  The limits
are outer fences of the quartiles; they replace fixed cutoffs and are joined to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import SPACE, stored, table

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Ratio, numerator, and the least spread (in thousandths) a fence assumes; a group without
# any spread would otherwise reject its first deviating row.
RATIOS = [
    ("symbol_rate", "n_symbols", 50),
    ("dup_line_rate", "n_dup_lines", 50),
    ("repeat_rate", "n_repeat_words", 40),
    ("word_length", "word_chars", 500),
]
FENCE = 4
LEAST_ROWS = 200
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in the text.

    Most texts repeat no window: they pay the window digests and one distinct.  Only
    the others sort their windows and merge the spans that the repeated ones cover.
    """
    def windows(digests):
        at = lambda i, k: F.element_at(digests, (i + F.lit(k)).cast("int"))
        starts = F.sequence(F.lit(1), F.size(digests) - 4)
        return F.transform(starts, lambda i: F.xxhash64(at(i, 0), at(i, 1), at(i, 2), at(i, 3), at(i, 4)))

    def covered(hashes):
        tagged = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s):
            same = lambda e, k: F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))
            return F.filter(s, lambda e, k: same(e, k - 1) | same(e, k + 1))

        starts = F.array_sort(F.transform(_let(tagged, repeated), lambda e: e["i"]))
        return _let(starts, lambda p: F.aggregate(
            F.transform(p, lambda i, k: F.least(F.lit(5), F.coalesce(F.get(p, k + 1) - i, F.lit(5)))),
            F.lit(0), lambda total, n: total + n,
        ))

    def counted(hashes):
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    digests = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 6, F.lit(0)).otherwise(
        _let(_let(digests, windows), counted)
    ).cast("long")


def base_counts(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``carry``, else all, as one struct) and the counts; a null text has no words."""
    body = F.coalesce(F.col(text), F.lit(""))
    # Only the first and the last part of a split can be empty.
    split = docs.select(
        F.struct(*(carry or ["*"])).alias("row"),
        F.array_remove(F.split(body, SPACE), "").alias("words"),
        body.alias("body"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    # Characters outside the symbols, counted without a second pass over the words.
    return split.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("body") - F.length(F.regexp_replace("body", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _ratios() -> list[Column]:
    return [F.floor(1000 * F.col(top) / F.greatest(F.col("n_words"), F.lit(1))).cast("long").alias(name)
            for name, top, _ in RATIOS]


def _cut(value: Column) -> Column:
    """Keep the seven leading bits of a non-negative integer."""
    low_bits = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    unit = F.pow(F.lit(2), low_bits).cast("long")
    return F.floor(value / unit).cast("long") * unit


def sketches(counted: DataFrame) -> DataFrame:
    """One row per group, ratio and cut value: the mergeable form of the quantiles."""
    values = counted.where(~F.col("base_failed")).select("lang", "source", *_ratios())
    long = values.select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(name).alias("ratio"), _cut(F.col(name)).alias("value")) for name, _, _ in RATIOS
    ])).alias("x"))
    return long.groupBy("lang", "source", F.col("x.ratio").alias("ratio"), F.col("x.value").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles of the sketches merged by ``keys``, one row per group: n and low/high per ratio."""
    merged = sketch.groupBy(*keys, "ratio", "value").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*keys, "ratio")
    ranked = merged.select(
        *keys, "ratio", "value", F.sum("n").over(by).alias("all"),
        F.sum("n").over(by.orderBy("value")).alias("upto"),
    )
    quarter = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("all"), F.col("value")))
    quartiles = ranked.groupBy(*keys, "ratio").agg(
        F.max("all").alias("rows"), quarter(1).alias("q1"), quarter(3).alias("q3"))
    floors = F.create_map(*[F.lit(x) for name, _, floor in RATIOS for x in (name, floor)])
    reach = FENCE * F.greatest(F.col("q3") - F.col("q1"), floors[F.col("ratio")])
    one = lambda name, value: F.max(F.when(F.col("ratio") == name, value))
    return quartiles.groupBy(*keys).agg(
        F.max("rows").alias("rows"),
        *[one(name, F.col("q3") + reach).alias(f"{name}_high") for name, _, _ in RATIOS],
        one("word_length", F.col("q1") - reach).alias("word_length_low"),
    )


LIMITS = [f"{name}_high" for name, _, _ in RATIOS] + ["word_length_low"]


def adaptive_limits(counted: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Limits per language and source, from the smallest level with enough rows."""
    sketch = stored(sketches(counted), "sketch")
    struct = lambda: F.struct(*LIMITS).alias("limits")
    by_source = fences(sketch, ["lang", "source"]).select("lang", "source", "rows", struct())
    by_lang = fences(sketch, ["lang"]).select("lang", F.col("rows").alias("l_rows"), struct().alias("l_limits"))
    overall = fences(sketch.withColumn("whole", F.lit(1)), ["whole"]).select("whole", struct().alias("w_limits"))
    return (
        by_source.join(by_lang, "lang").withColumn("whole", F.lit(1)).join(overall, "whole")
        .select("lang", "source", F.when(F.col("rows") >= least_rows, F.col("limits"))
                .when(F.col("l_rows") >= least_rows, F.col("l_limits")).otherwise(F.col("w_limits")).alias("limits"))
    )


def quality_rules(
    docs: DataFrame, ident: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    least_rows: int = LEAST_ROWS, carry: list[str] | None = None,
) -> DataFrame:
    """``row`` (the columns ``carry``, else all, as one struct), the counts, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails the base rule.  A null language or source is a
    group of its own (the empty name).  Groups below ``least_rows`` rows use the limits of their
    language, then of the whole table.  Ties and repeated rows are judged one by one; an empty
    table gives no rows.  Extra columns of any name only travel in ``row``.
    """
    key = lambda c: F.coalesce(F.col(f"row.{c}").cast("string"), F.lit(""))
    counted = stored(
        base_counts(docs, text, carry).select("*", key(lang).alias("lang"), key(source).alias("source")), "counts")
    # A written table has a known size: Spark broadcasts it below its limit and sort-merges above.
    limits = stored(adaptive_limits(counted, least_rows), "limits")
    inside = F.col("word_length") >= F.col("limits.word_length_low")
    for name, _, _ in RATIOS:
        inside = inside & (F.col(name) <= F.col(f"limits.{name}_high"))
    return (
        counted.select("*", *_ratios()).join(limits, ["lang", "source"], "left")
        .select("row", *COUNTS, "base_failed", F.coalesce(~F.col("base_failed") & inside, F.lit(False)).alias("kept"))
    )


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # The text is measured and left behind: only the keys of its row go on.
    return quality_rules(docs, carry=["doc_id", "lang", "source"]).select(F.col("row.doc_id").alias("doc_id"), *COUNTS, "base_failed", "kept")


ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS body, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT doc_id, i, list_slice(words, i, i + 4) AS win
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM docs WHERE len(words) > 5)
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS times FROM windows), range(0, 5) AS r(k)
  WHERE times > 1 GROUP BY doc_id
), line_counts AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), counts AS (
  SELECT d.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM docs d LEFT JOIN line_counts l USING (doc_id) LEFT JOIN covered c USING (doc_id)
), rated AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         1000 * n_symbols // greatest(n_words, 1) AS f1, 1000 * n_dup_lines // greatest(n_words, 1) AS f2,
         1000 * n_repeat_words // greatest(n_words, 1) AS f3, 1000 * word_chars // greatest(n_words, 1) AS f4
  FROM counts
), long AS (
  SELECT lang, source, f, v FROM (
    SELECT lang, source, unnest([1, 2, 3, 4]) AS f, unnest([f1, f2, f3, f4]) AS v FROM rated WHERE NOT base_failed)
), cut AS (
  SELECT lang, source, f, (v >> e) << e AS v
  FROM (SELECT *, greatest(length(ltrim(bin(v), '0')) - 7, 0)::INT AS e FROM long)
), levels AS (
  SELECT 1 AS lv, lang, source, f, v FROM cut UNION ALL SELECT 2, lang, '', f, v FROM cut
  UNION ALL SELECT 3, '', '', f, v FROM cut
), fences AS (
  SELECT lv, lang, source, f, count(*) AS n, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3,
         4 * greatest(quantile_disc(v, 0.75) - quantile_disc(v, 0.25), (CASE f WHEN 3 THEN 40 WHEN 4 THEN 500 ELSE 50 END)) AS reach
  FROM levels GROUP BY lv, lang, source, f
), limits AS (
  SELECT a.lang, a.source, a.f, CASE WHEN a.n >= 200 THEN a.q3 + a.reach WHEN b.n >= 200 THEN b.q3 + b.reach
         ELSE c.q3 + c.reach END AS high,
         CASE WHEN a.n >= 200 THEN a.q1 - a.reach WHEN b.n >= 200 THEN b.q1 - b.reach ELSE c.q1 - c.reach END AS low
  FROM fences a JOIN fences b ON b.lv = 2 AND b.lang = a.lang AND b.f = a.f JOIN fences c ON c.lv = 3 AND c.f = a.f
  WHERE a.lv = 1
), wide AS (
  SELECT lang, source, max(high) FILTER (f = 1) AS h1, max(high) FILTER (f = 2) AS h2, max(high) FILTER (f = 3) AS h3,
         max(high) FILTER (f = 4) AS h4, max(low) FILTER (f = 4) AS l4
  FROM limits GROUP BY lang, source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND f1 <= h1 AND f2 <= h2 AND f3 <= h3 AND f4 <= h4 AND f4 >= l4, FALSE) AS kept
FROM rated LEFT JOIN wide USING (lang, source)
"""
