"""Best-fit packing planned on the histogram of lengths.

The plan places counts, not documents: there are at most as many lengths as a sequence
has tokens, so the driver works on a few thousand numbers however many documents there are.
It says which ranks within a length go to which sequences, and how many to each; each piece then takes its
slot by its rank within its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import map_batches, per_process, stored, table
from marlstone.llm.tokens import WordBpe

CAPACITY = 4096
END_ID = 1


def plan_best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Segments (length, first rank, count, per, first sequence, offset).

    Rank first+i goes to sequence first+i//per, as piece i%per from the offset on.  Longest first; a piece
    goes to the sequence with the least room that still fits it.  A sequence that took a piece has less room
    than before, so equal pieces fill one sequence after the other.  Sequences in the same state are
    handled as one range.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    segments = []
    sequences = 0

    def keep(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                room[left] = []
                insort(sizes, left)
            room[left].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            k = bisect_left(sizes, length)
            if k < len(sizes):
                left = sizes[k]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left], sizes[k]
            else:
                left, first, n = capacity, sequences, -(-todo // (capacity // length))
                sequences += n
            per = left // length
            full = min(n, todo // per)
            # Full sequences, and at most one that takes what remains.
            for many, each in ((full, per), (1, todo - full * per) if full < n and todo > full * per else (0, 1)):
                if many:
                    segments.append((length, rank, many * each, each, first, capacity - left))
                    keep(left - each * length, first, many)
                    rank, todo, first, n = rank + many * each, todo - many * each, first + many, n - many
            keep(left, first, n)
    return segments


def tokenized_pieces(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY,
    ident: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in the same task."""
    def make():
        encoder = per_process(("word_bpe", tokenizer, end_id), lambda: WordBpe(tokenizer, end_id))
        seen: Counter = Counter()
        part = TaskContext.get().partitionId()

        def work(batch):
            out = {c: [] for c in (ident, "piece", "start", "length", "ids_crc32", "rank")}
            idents, texts = batch.column(0).to_pylist(), batch.column(1)
            for i in range(0, len(idents), 64):
                for one, ids in zip(idents[i:i + 64], encoder.encode(texts.slice(i, 64).to_pylist())):
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[at:at + 4 * capacity]
                        length = len(cut) // 4
                        for c, v in zip(out, (one, piece, at // 4, length, zlib.crc32(cut), seen[length])):
                            out[c].append(v)
                        seen[length] += 1
            return out | {"part": [part] * len(out["piece"])}

        # Idle workers would hold the words while later stages need the room.
        work.end = encoder.forget
        return work

    kind = docs.schema[ident].dataType.simpleString()
    return map_batches(
        docs.select(ident, text),
        f"`{ident}` {kind}, piece int, start long, length long, ids_crc32 long, rank long, part int", make)


def pack_best_fit(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY,
    ident: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces with the sequence and the offset they go to; sequences are gapless from 0.

    A null or empty text is its end id alone.  Repeated rows and identifiers are packed as they
    come.  Only texts above ``capacity`` tokens are cut.  Empty table: no rows.  Other columns
    are not read, so their names cannot clash.
    """
    spark = docs.sparkSession
    # Written once: a task's ranks are then fixed, whatever runs again later.
    pieces = stored(tokenized_pieces(docs, tokenizer, end_id, capacity, ident, text), "pieces")
    tally = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tally = stored(tally, "tally")
    based = tally.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    # At most ``capacity`` rows reach the driver.
    counts = {r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    for length, rank, _, per, sequence, offset in plan_best_fit(counts, capacity):
        slots.setdefault(length, []).append((rank, per, sequence, offset))
    plan = spark.createDataFrame(
        list(slots.items()), "length long, slots array<struct<rank: long, per: long, sequence: long, offset: long>>")

    ranked = pieces.join(based, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    rank = F.col("rank")
    # At most ``capacity`` rows, and the segments of the plan do not grow with the documents.
    placed = ranked.join(F.broadcast(plan), "length").withColumn(
        "slot", F.element_at(F.filter("slots", lambda s: s["rank"] <= rank), -1))
    nth, per = rank - F.col("slot.rank"), F.col("slot.per")
    return placed.select(
        ident, "piece", "start", "length", "ids_crc32",
        (F.col("slot.sequence") + F.floor(nth / per)).alias("sequence_id"),
        (F.col("slot.offset") + nth % per * F.col("length")).alias("offset"),
    )


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_best_fit(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
