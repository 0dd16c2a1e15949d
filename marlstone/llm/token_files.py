"""Token ids in binary shards: byte planes of fixed-size blocks, with a chunk index.

A shard holds the ids of a range of documents in ascending order.  Ids are cut into blocks; a block's
little-endian 32-bit ids are transposed into planes (all first bytes, all second bytes, ..., or
single bits), each plane is compressed with zstandard on its own, and an index at the end of
the file says where each block's planes lie and how many ids each document has:

    magic | planes of block 0 | planes of block 1 | ... | index (zstandard) | index offset, index bytes | magic

Index: counts of blocks and documents, then per block: offset, ids, one length per plane; then the
documents' ids and lengths, and which documents have no id.  All integers are little-endian 64-bit.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm import files
from marlstone.llm.common import per_process, stored, table
from marlstone.llm.tokens import ByteBpe
from marlstone.session import scratch_path

MAGIC = b"MTOKPL01"
BLOCK_IDS = 1 << 16
LEVEL = 3
END_ID = 2


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Transpose 32-bit ids into 4 byte planes or 32 bit planes."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        unpacked = np.unpackbits(raw, axis=1, bitorder="little")
        return [np.packbits(unpacked[:, k]).tobytes() for k in range(32)]
    return [raw[:, k].tobytes() for k in range(4)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 32:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes], axis=1)
        return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")
    return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).reshape(-1).view("<u4")


class ShardWriter:
    def __init__(self, out, block_ids: int = BLOCK_IDS, bits: bool = False):
        self.out, self.block_ids, self.bits = out, block_ids, bits
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.pending, self.blocks, self.docs, self.lengths, self.nulls = bytearray(), [], [], [], []
        self.at = out.write(MAGIC)

    def add(self, ident: int | None, ids: bytes) -> None:
        self.docs.append(ident or 0)
        self.nulls.append(ident is None)
        self.lengths.append(len(ids) // 4)
        self.pending += ids
        self._flush(self.block_ids)

    def _flush(self, least: int) -> None:
        size, start = 4 * self.block_ids, 0
        while len(self.pending) - start >= max(4 * least, 4):
            block = np.frombuffer(bytes(self.pending[start:start + size]), "<u4")
            planes = [self.packer.compress(p) for p in to_planes(block, self.bits)]
            self.blocks.append([self.at, len(block), *map(len, planes)])
            self.at += sum(self.out.write(p) for p in planes)
            start += 4 * len(block)
        del self.pending[:start]

    def close(self) -> None:
        self._flush(1)
        index = struct.pack("<2q", len(self.blocks), len(self.docs)) + b"".join(
            np.asarray(part, "<i8").tobytes() for part in (self.blocks, self.docs, self.lengths, self.nulls))
        packed = self.packer.compress(index)
        self.out.write(packed + struct.pack("<2q", self.at, len(packed)) + MAGIC)


class ShardReader:
    """Index first, then any block by itself."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - 24)
        at, length = struct.unpack("<2q", source.read(16))
        if source.read(8) != MAGIC:
            raise ValueError("not a token shard, or cut short")
        self.opener = zstandard.ZstdDecompressor()
        source.seek(at)
        index = self.opener.decompress(source.read(length))
        n_blocks, n_docs = struct.unpack_from("<2q", index)
        rest = np.frombuffer(index, "<i8", offset=16)
        tail = rest[len(rest) - 3 * n_docs:]
        self.blocks = rest[:len(rest) - 3 * n_docs].reshape(n_blocks, -1)
        self.docs, self.lengths, self.nulls = tail[:n_docs], tail[n_docs:2 * n_docs], tail[2 * n_docs:]

    def block(self, k: int) -> np.ndarray:
        at, n, *sizes = self.blocks[k].tolist()
        self.source.seek(at)
        return from_planes([self.opener.decompress(self.source.read(s)) for s in sizes], n)

    def documents(self):
        """Each document's id and ids; holds one block and one document at a time."""
        k, held = 0, np.empty(0, "<u4")
        for ident, length, null in zip(self.docs.tolist(), self.lengths.tolist(), self.nulls.tolist()):
            parts, need = [], length
            while need:
                if not len(held):
                    held, k = self.block(k), k + 1
                parts.append(held[:need])
                held = held[len(parts[-1]):]
                need -= len(parts[-1])
            yield None if null else ident, np.concatenate(parts) if parts else held[:0]


def write_token_shards(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str, ident: str = "doc_id", text: str = "text",
    block_ids: int = BLOCK_IDS, bits: bool = False,
) -> DataFrame:
    """Tokenize and write; returns the shards that were committed: path, shard (ascending), n_docs, n_ids.

    Null texts count as empty (the end id alone), null identifiers come first, repeated identifiers
    stay neighbours, an empty table gives no shard, other columns are not read.
    """
    def make():
        encoder = per_process(("byte_bpe", tokenizer, end_id), lambda: ByteBpe(tokenizer, end_id))

        def run(batches):
            path, writer, total = None, None, 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                if writer is None:
                    path = files.unique_name(folder, "tokens", ".mtok")
                    opened = files.writing(path)
                    writer = ShardWriter(opened.__enter__(), block_ids, bits)
                idents = batch.column(0).to_pylist()
                texts = batch.column(1)
                for i in range(0, len(idents), 64):
                    part = texts.slice(i, 64).to_pylist()
                    for one, ids in zip(idents[i:i + 64], encoder.encode(part)):
                        writer.add(one, ids)
                        total += len(ids) // 4
            if writer is not None:
                writer.close()
                opened.__exit__(None, None, None)
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([path]), "shard": pa.array([TaskContext.get().partitionId()], pa.int32()),
                    "n_docs": pa.array([len(writer.docs)], pa.int64()), "n_ids": pa.array([total], pa.int64())})
        return run

    ordered = docs.select(F.col(ident).cast("long").alias("id"), F.col(text).alias("text")).repartitionByRange(
        "id").sortWithinPartitions("id")
    return stored(
        ordered.mapInArrow(lambda batches: make()(batches), "path string, shard int, n_docs long, n_ids long"),
        "token-shards")


def read_token_shards(shards: DataFrame, ident: str = "doc_id") -> DataFrame:
    """From the files: each document's place among all ids, its length and the checksum of its ids."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one narrow row per shard
    based = shards.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    # One task per shard; without a number, the small rows would be put into one task.
    dealt = based.repartition(max(1, shards.count()))

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.reading(path) as source:
                    rows: list[tuple] = []
                    for one, ids in ShardReader(source).documents():
                        rows.append((one, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(rows) >= 4096:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    def _rows(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*rows)], names=[ident, "start", "n_tokens", "ids_crc32"])

    return dealt.mapInArrow(read, f"`{ident}` long, start long, n_tokens long, ids_crc32 long")


def op5_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    shards = write_token_shards(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), END_ID,
        scratch_path(spark, "llm-token-files"))
    return read_token_shards(shards)
