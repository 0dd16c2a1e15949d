"""Exact dedup by content sort.

Sampled splitters range-partition the normalised bytes, an external sort places equal
texts next to each other, and a window walks the sorted rows, compares each whole text with
its neighbour's and finds the smallest identifier of each run.

Splitters hold a short prefix and a digest of the text, never the text itself, so what
Spark samples to the driver stays small.  A text with very many copies is cut into pieces
by identifier, and the few totals of such texts are joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import SPACE, stored, table, tag

PREFIX_CHARS = 32
# A text is hot with more copies than HOT_COPIES and than one row in HOT_SHARE: fewer than
# HOT_SHARE texts can be, whatever the size of the table.
HOT_COPIES = 256
HOT_SHARE = 2000


def content_sort_dedup(
    docs: DataFrame, ident: str = "doc_id", text: str = "text", carry: bool = True,
    hot_copies: int = HOT_COPIES, hot_share: int = HOT_SHARE,
) -> DataFrame:
    """One row per input row with what became of it.

    Returns ``row`` (all input columns as one struct; only with ``carry``), the identifier,
    ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical after every run of ASCII white space is replaced by one
    space.  A null text counts as empty.  Of equal texts exactly one row stays: the one with
    the smallest identifier; of repeated rows with that identifier one stays.  A null identifier
    is larger than any other, so such a row stays only if its whole group has none (keep_id is
    then null).  Empty table: no rows.  Extra columns of any name only travel in ``row``.
    """
    norm, sha, salt, row = tag("norm"), tag("sha"), tag("salt"), tag("row")
    pieces, low, size, rank, prefix, ident_ = (tag(x) for x in ("pieces", "low", "size", "rank", "prefix", "id"))
    rows = docs.select(
        *([F.struct("*").alias(row)] if carry else []),
        F.col(ident).alias(ident_),
        F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ").alias(norm),
    ).withColumn(sha, F.sha2(norm, 256))

    total = docs.count()
    counts = rows.groupBy(sha).agg(F.count(F.lit(1)).alias(size), F.min(ident_).alias(low))
    piece_rows = max(hot_copies, total // hot_share)
    hot_texts = counts.where((F.col(size) > hot_copies) & (F.col(size) * hot_share > total))
    # Fewer than ``hot_share`` rows by arithmetic, so the broadcast is bounded.
    hot = F.broadcast(stored(
        hot_texts.withColumn(pieces, F.ceil(F.col(size) / piece_rows).cast("long")).coalesce(1), "hot-texts"))

    dealt = (
        rows.join(hot, sha, "left")
        .withColumn(salt, F.when(F.col(pieces).isNotNull(), F.pmod(F.xxhash64(ident_), F.col(pieces))).otherwise(0))
        .withColumn(prefix, F.substring(norm, 1, PREFIX_CHARS))
        .repartitionByRange(prefix, sha, salt)
    )
    run = Window.partitionBy(prefix, sha, norm, salt).orderBy(F.col(ident_).asc_nulls_last())
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    walked = dealt.select(
        *([row] if carry else []), ident_, sha,
        F.coalesce(low, F.min(ident_).over(whole)).alias("keep_id"),
        F.coalesce(size, F.count(F.lit(1)).over(whole)).alias("group_size"),
        F.row_number().over(run).alias(rank), salt,
        F.pmod(F.xxhash64(low), F.col(pieces)).alias(pieces),
    )
    # Copies with the kept identifier share one piece, so the first of that piece is the one.
    in_keeping_piece = F.col(pieces).isNull() | (F.col(salt) == F.col(pieces))
    first = (F.col(rank) == 1) & in_keeping_piece & F.col(ident_).eqNullSafe(F.col("keep_id"))
    return walked.select(
        *([F.col(row).alias("row")] if carry else []),
        F.col(ident_).alias(ident), "keep_id", "group_size", first.alias("kept"), F.col(sha).alias("text_sha256"),
    )


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return content_sort_dedup(docs, carry=False)


ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""
