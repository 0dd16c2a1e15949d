"""Versioned dimensions: validity intervals and lookups at a point in time.

An interval ends where the next version of the same key starts.  One window per
key gives that, but a key that holds a large part of the log would land in one
task.  A frequent-items sketch finds candidates for such hot keys in one pass without a shuffle of the
keys, and exact counts decide about the candidates alone.  Without hot keys, rows go through one
shuffle by key.  Hot keys are cut into time slices: the window runs per (key, slice), and the
boundary is carried from slice to slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.operators.dedup import dedup_by_key, latest_by_key

START, END = "__START_AT", "__END_AT"

# A key is hot with more than HOT_ROWS rows and more than one row in HOT_SHARE.
HOT_ROWS = 1_000_000
HOT_SHARE = 10_000
# Items a sketch keeps track of.  It misses no item above 7 rows in TRACKED, which is less than one in HOT_SHARE.
TRACKED = 1 << 17
# Sketches of all tasks meet in so many groups before they meet in one.
SKETCH_GROUPS = 64
# One minute: at microsecond resolution a key has at most 60 million versions in
# a slice, and ten years are about five million narrow summary rows.
SLICE_MICROS = 60_000_000
SLICE_INTEGERS = 1_000_000


def _too_small_for_hot(df: DataFrame, hot_rows: int) -> bool:
    """Whether the planner's size estimate rules out ``hot_rows`` rows of one byte each."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= hot_rows


def frequent_hashes(df: DataFrame, keys: Sequence[str], at_least: int) -> list[int]:
    """Hashes of keys that may have ``at_least`` rows, by sketch; none that has them and one in HOT_SHARE is missed."""
    hashed = df.select(F.xxhash64(*keys).alias("_h"), F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_g"))
    states = hashed.groupBy("_g").agg(F.expr(f"approx_top_k_accumulate(_h, {TRACKED})").alias("_s"))
    if hashed.isEmpty():
        return []
    merged = states.agg(F.expr(f"approx_top_k_combine(_s, {TRACKED})").alias("_s"))
    top = merged.select(F.expr(f"approx_top_k_estimate(_s, {min(HOT_SHARE, TRACKED)})").alias("top")).first()["top"]
    return [r["item"] for r in top if r["count"] >= at_least]


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> list[Row]:
    """The hot keys with their number of rows (``_rows``); fewer than ``HOT_SHARE`` by construction.

    Fewer than n keys can each hold more than an n-th of the rows, whatever the size of the
    table.  Only rows of candidates are counted exactly, so that without any no key is shuffled.
    """
    if _too_small_for_hot(df, hot_rows):
        return []
    candidates = frequent_hashes(df, keys, hot_rows // 2)
    if not candidates:
        return []
    spark = df.sparkSession
    chosen = F.broadcast(spark.createDataFrame([(h,) for h in candidates], "_h long"))
    counted = df.select(*keys, F.xxhash64(*keys).alias("_h"))
    counts = counted.join(chosen, "_h", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = df.count()
    return [r for r in counts.collect() if r["_rows"] > hot_rows and r["_rows"] * HOT_SHARE > total]


def _marked(df: DataFrame, keys: Sequence[str], hot: list[Row], how: str = "left") -> DataFrame:
    """``df`` with ``_hot`` for rows of hot keys; a NULL key is a key."""
    spark = df.sparkSession
    fields = [df.schema[k] for k in keys]
    small = spark.createDataFrame([tuple(r[k] for k in keys) for r in hot], T.StructType(
        [T.StructField(f"_hot_{i}", f.dataType) for i, f in enumerate(fields)])).withColumn("_hot", F.lit(True))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{i}")) for i, k in enumerate(keys)])
    return df.join(F.broadcast(small), same, how).drop(*[f"_hot_{i}" for i in range(len(keys))])


def _slice_of(column: Column, data_type: T.DataType) -> Column:
    """Number of the slice a sequence value falls in; grows with the value."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(F.unix_micros(column.cast("timestamp")) / F.lit(SLICE_MICROS))
    if isinstance(data_type, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(data_type, T.IntegralType):
        return F.floor(column / F.lit(SLICE_INTEGERS))
    raise TypeError(f"a sequence must be a timestamp, a date or an integer, not {data_type.simpleString()}")


def unsequenced(changes: DataFrame, sequence: str) -> DataFrame:
    """Changes without a sequence value: they have no place in the history."""
    return changes.where(F.col(sequence).isNull())


def _without_repeats(sliced: DataFrame, keys: list[str], sequence: str, track: Sequence[str]) -> DataFrame:
    """Drop versions whose tracked columns equal those of the version before."""
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(sequence)
    across = Window.partitionBy(*keys).orderBy("_slice")
    tracked = F.struct(*track)
    last_of_slice = sliced.where(F.col("_hot")).groupBy(*keys, "_slice").agg(
        F.max_by(tracked, sequence).alias("_last")
    )
    carried = last_of_slice.select(*keys, "_slice", F.lag("_last").over(across).alias("_carried"))
    compared = (
        sliced.withColumn("_before", F.lag(tracked).over(in_slice))
        .join(carried.withColumnsRenamed({k: f"_of_{k}" for k in keys} | {"_slice": "_of_slice"}), _same_slice(keys), "left")
        .withColumn("_before", F.coalesce("_before", "_carried"))
    )
    changed = F.col("_before").isNull() | ~tracked.eqNullSafe(F.col("_before"))
    return compared.where(changed).drop("_before", "_carried", "_of_slice", *[f"_of_{k}" for k in keys])


def _between_versions(versions: DataFrame, keys: list[str], sequence: str, track: Sequence[str] | None) -> DataFrame:
    """Interval ends where every key fits a task: all of it happens where a shuffle by key has put the rows."""
    by_key = Window.partitionBy(*keys).orderBy(sequence)
    if track:
        tracked = F.struct(*track)
        before = F.lag(F.struct(tracked.alias("t"))).over(by_key)
        versions = versions.withColumn("_before", before).where(
            F.col("_before").isNull() | ~tracked.eqNullSafe(F.col("_before.t"))).drop("_before")
    return versions.withColumn(END, F.lead(sequence).over(by_key))


def scd2_versions(
    changes: DataFrame, keys: Sequence[str], sequence: str,
    track: Sequence[str] | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All versions with their validity: ``__START_AT`` and ``__END_AT`` (NULL = current).

    Each distinct (key, sequence) is one version, placed by its sequence and not
    by its arrival, so late changes need no special care.  Changes without a
    sequence are left out (see ``unsequenced``).  With ``track``, a version that
    repeats the tracked columns of its predecessor is merged into it.
    """
    keys = list(keys)
    changes = changes.where(F.col(sequence).isNotNull())
    slice_no = _slice_of(F.col(sequence), changes.schema[sequence].dataType)
    hot = hot_keys(changes, keys, hot_rows)
    if not hot:
        one_shuffle = dedup_by_key(changes.repartition(*keys), [*keys, sequence])
        return _between_versions(one_shuffle, keys, sequence, track).select(
            *changes.columns, F.col(sequence).alias(START), END)

    def sliced(df: DataFrame, how: str) -> DataFrame:
        return _marked(df, keys, hot, how).withColumn("_slice", F.when(F.col("_hot"), slice_no))

    versions = sliced(dedup_by_key(changes, [*keys, sequence]), "left")
    if track:
        versions = _without_repeats(versions, keys, sequence, track)
        hot_versions = versions.where(F.col("_hot"))
    else:
        hot_versions = sliced(changes.select(*keys, sequence), "inner")

    in_slice = Window.partitionBy(*keys, "_slice").orderBy(sequence)
    across = Window.partitionBy(*keys).orderBy("_slice")
    slice_starts = hot_versions.groupBy(*keys, "_slice").agg(F.min(sequence).alias("_first"))
    next_slices = slice_starts.select(*keys, "_slice", F.lead("_first").over(across).alias("_next"))
    return (
        versions.withColumn(END, F.lead(sequence).over(in_slice))
        .join(next_slices.withColumnsRenamed({k: f"_of_{k}" for k in keys} | {"_slice": "_of_slice"}),
              _same_slice(keys), "left")
        .select(
            *changes.columns,
            F.col(sequence).alias(START),
            F.coalesce(F.col(END), F.col("_next")).alias(END),
        )
    )


def _same_slice(keys: Sequence[str]) -> Column:
    """Rows of a slice and what was found for it; a NULL key is a key, a NULL slice is none."""
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return reduce(lambda a, b: a & b, same, F.col("_slice") == F.col("_of_slice"))


def current_versions(changes: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The open versions only, without building the history: two aggregates."""
    dated = changes.where(F.col(sequence).isNotNull())
    return latest_by_key(dedup_by_key(dated, [*keys, sequence]), keys, sequence)


def version_at(
    rows: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, start: str,
    columns: Sequence[str], hot_rows: int = HOT_ROWS, salts: int = 32,
) -> DataFrame:
    """Add to each row a struct ``_found``: ``columns`` of the version valid at time ``at`` (NULL if none).

    A join on the key with a range condition would build every (row, version) pair
    of a key first.  Here rows and versions are laid on one time line per key
    and the last version is carried forward with its columns: one shuffle, linear, and each input is read
    once.  Rows without a key or a time match nothing and are spread over all tasks.  Versions are
    unique per key and start; those without a start are never valid.
    """
    keys = list(keys)
    row_columns = rows.columns
    spread = F.xxhash64(*[F.col(f"_row.{c}") for c in row_columns])
    matches_nothing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.col("_at").isNull())
    row_side = rows.select(*keys, F.col(at).alias("_at"), F.struct(*row_columns).alias("_row"))
    version_side = versions.where(F.col(start).isNotNull()).select(
        *keys, F.col(start).alias("_at"), F.struct(*columns).alias("_version"))
    hot = hot_keys(rows.select(*keys).unionByName(versions.select(*keys)), keys, hot_rows)

    if hot:
        slice_no = _slice_of(F.col("_at"), rows.schema[at].dataType)
        row_side = _marked(row_side, keys, hot).withColumn("_slice", F.when(F.col("_hot"), slice_no))
        version_side = _marked(version_side, keys, hot).withColumn("_slice", F.when(F.col("_hot"), slice_no))
        # The last version of all earlier slices opens every slice that holds rows.
        held = row_side.where(F.col("_hot") & F.col("_slice").isNotNull()).groupBy(*keys, "_slice").agg(
            F.count(F.lit(1)).alias("_n"))
        last = version_side.where(F.col("_hot")).groupBy(*keys, "_slice").agg(
            F.max_by(F.struct("_at", "_version"), "_at").alias("_last"))
        earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        per_slice = held.unionByName(last, allowMissingColumns=True).groupBy(*keys, "_slice").agg(
            F.max("_n").alias("_n"), F.first("_last", ignorenulls=True).alias("_last"))
        opened = per_slice.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).where(
            F.col("_n").isNotNull())
        carried = opened.where(F.col("_carried").isNotNull()).select(
            *keys, F.col("_carried._at").alias("_at"), F.col("_carried._version").alias("_version"),
            F.lit(True).alias("_hot"), "_slice")
        version_side = version_side.unionByName(carried)
        # A slice that is still hot: its rows are spread over copies of its versions.
        crowded = F.broadcast(opened.where(F.col("_n") > hot_rows).select(
            *[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_slice").alias("_of_slice"),
            F.least(F.lit(salts), F.ceil(F.col("_n") / F.lit(max(hot_rows, 1))).cast("int")).alias("_salts")))
        of = ["_of_slice", *[f"_of_{k}" for k in keys]]
        row_side = row_side.join(crowded, _same_slice(keys), "left").drop(*of).withColumn(
            "_salt", F.pmod(spread, F.coalesce("_salts", F.lit(1))).cast("int"))
        version_side = version_side.join(crowded, _same_slice(keys), "left").drop(*of).withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
    else:
        row_side = row_side.withColumns({"_slice": F.lit(None).cast("long"), "_salt": F.lit(0)})
        version_side = version_side.withColumns({"_slice": F.lit(None).cast("long"), "_salt": F.lit(0)})
    row_side = row_side.withColumn("_slice", F.when(matches_nothing, spread).otherwise(F.col("_slice")))

    time_line = row_side.unionByName(version_side, allowMissingColumns=True)
    # At equal times a version comes before the rows it applies to.
    so_far = (
        Window.partitionBy(*keys, "_slice", "_salt")
        .orderBy("_at", F.col("_row").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = F.when(F.col("_at").isNotNull(), F.last("_version", ignorenulls=True).over(so_far))
    return time_line.withColumn("_found", found).where(F.col("_row").isNotNull()).select("_row.*", "_found")


def version_start_at(
    rows: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, start: str,
    into: str = "version_start", hot_rows: int = HOT_ROWS, salts: int = 32,
) -> DataFrame:
    """Add to each row the start of the version valid at time ``at`` (NULL if none)."""
    dated = version_at(rows, versions, keys, at, start, [start], hot_rows, salts)
    return dated.select(*rows.columns, F.col(f"_found.{start}").alias(into))


def point_in_time_join(
    rows: DataFrame, dimension: DataFrame, key: str, at: str,
    columns: Sequence[str], start: str = "valid_from", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Attach ``columns`` of the version that was valid at ``at``; NULLs if none was."""
    dated = version_at(rows, dimension, [key], at, start, columns, hot_rows)
    return dated.select(*rows.columns, *[F.col(f"_found.{c}").alias(c) for c in columns])
