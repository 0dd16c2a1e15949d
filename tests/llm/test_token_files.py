import random
import io
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from marlstone.llm import packing, token_files
from marlstone.llm.tokens import ByteBpe, WordBpe
from marlstone.session import scratch_path

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ODD = [None, "", " ", "  two  spaces ", "a\n\n b\tc", "line.\nNext, one.", "x<|endoftext|> y <|startoftext|>z", "\x00a. b",
       "It's 'S ok.,", "é à ü 漢字 　wide\xa0hard", "A.B. c.", "1,000, 2.", "word " * 3000, "tail\n", "\nhead", "é ."]
CLASHING = ["start", "length", "path", "rank", "slot", "part"]


def direct(path, end, text):
    return np.array(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@pytest.mark.parametrize("kind, path", [(ByteBpe, BYTE), (WordBpe, WORD)])
def test_chunks_give_the_ids_of_the_text(kind, path, prose, monkeypatch):
    texts = [*ODD, *(prose(i, 50).replace(" ", ". ", 5).title() for i in range(20))]
    expected = [direct(path, 7, t).tobytes() for t in texts]
    assert kind(path, 7).encode(texts) == expected
    monkeypatch.setattr("marlstone.llm.tokens.MEMO_CHUNKS", 30)
    encoder = kind(path, 7)
    assert [encoder.encode([t])[0] for t in texts] == expected


@pytest.mark.parametrize("kind, path", [(ByteBpe, BYTE), (WordBpe, WORD)])
def test_a_word_asks_the_model_once_while_it_is_kept(kind, path, monkeypatch):
    texts = ["we'll they're I'd x'Yz 's's '' 's9 'lL 'm\u00e9 d'un l'\u00e9t\u00e9 ' t 've", "so they're not 're 'd'd 9'9's"]
    monkeypatch.setattr("marlstone.llm.tokens.MEMO_WORDS", 1000)
    encoder, asked = kind(path, 7), []
    tokenize = encoder.tokenize
    encoder.tokenize = lambda word: asked.append(word) or tokenize(word)
    expected = [direct(path, 7, t).tobytes() for t in texts]
    assert [encoder.encode(texts) for _ in range(3)] == [expected] * 3
    assert len(asked) == len(set(asked)) == len(encoder.word_ids)
    monkeypatch.setattr("marlstone.llm.tokens.MEMO_WORDS", 8)
    small = kind(path, 7)
    assert [small.encode(texts) for _ in range(3)] == [expected] * 3
    assert len(small.word_ids) <= 4 and len(small.word_ids.before) <= 4


@pytest.mark.parametrize("bits", [False, True])
def test_shard_round_trip(bits):
    draw = np.random.default_rng(1)
    docs = [(i, draw.integers(0, 2**32 if i % 2 else 60_000, n, dtype=np.uint32)) for i, n in enumerate([0, 1, 5, 100, 64, 33, 0])]
    docs.append((None, np.arange(3, dtype=np.uint32)))
    out = io.BytesIO()
    writer = token_files.ShardWriter(out, 64, bits)
    for k, ids in docs:
        writer.add(k, ids.astype("<u4").tobytes())
    writer.close()

    class Source(io.BytesIO):
        def size(self):
            return len(self.getbuffer())

    reader = token_files.ShardReader(Source(out.getvalue()))
    assert len(reader.blocks) == 4 and (reader.block(1) == np.concatenate([d for _, d in docs])[64:128]).all()
    assert [(k, v.tolist()) for k, v in reader.documents()] == [(k, v.tolist()) for k, v in docs]
    with pytest.raises(ValueError):
        token_files.ShardReader(Source(out.getvalue()[:-5]))


def test_files_of_a_table(spark, documents):
    rows = [(100 - i, t) for i, t in enumerate(ODD)] + [(3, "again"), (3, "again")]
    shards = token_files.write_token_shards(documents(rows, CLASHING), BYTE, 2, scratch_path(spark, "t"), block_ids=128)
    got = sorted(tuple(r) for r in token_files.read_token_shards(shards).collect())
    start, expected = 0, []
    for k, t in sorted(rows, key=lambda r: r[0]):
        ids = direct(BYTE, 2, t)
        expected.append((k, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == sorted(expected)


def test_files_of_an_empty_table_and_null_ids(spark, documents):
    folder = scratch_path(spark, "t")
    assert token_files.read_token_shards(token_files.write_token_shards(documents([]), BYTE, 2, folder)).count() == 0
    shards = token_files.write_token_shards(documents([(1, "b"), (None, "a")]), BYTE, 2, folder)
    assert [r.doc_id for r in token_files.read_token_shards(shards).orderBy("start").collect()] == [None, 1]


def packed(rows, capacity=4096):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return by_sequence


def test_packing_of_a_table(spark, documents):
    rows = [*enumerate(ODD), (50, "long " * 10_000), (3, "twice"), (3, "twice")]
    got = packing.pack_best_fit(documents(rows, CLASHING), WORD).collect()
    expected = []
    for k, t in rows:
        ids = direct(WORD, 1, t)
        expected += [(k, i, a, len(ids[a:a + 4096]), zlib.crc32(ids[a:a + 4096].tobytes()))
                     for i, a in enumerate(range(0, len(ids), 4096))]
    assert sorted(tuple(r)[:5] for r in got) == sorted(expected)
    assert len(packed(got)) == -(-sum(e[3] for e in expected) // 4096)


def test_packing_of_an_empty_table(spark, documents):
    assert packing.pack_best_fit(documents([]), WORD).count() == 0


def placed_by_plan(counts, capacity):
    placed, ranks = {}, {}
    for length, rank, n, per, sequence, offset in packing.plan_best_fit(counts, capacity):
        for i in range(n):
            at = sequence + i // per
            assert placed.get(at, 0) == offset + i % per * length
            placed[at] = placed.get(at, 0) + length
            ranks.setdefault(length, []).append(rank + i)
    assert max(placed.values()) <= capacity
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(c)) for k, c in counts.items()}
    return sorted(placed.values())


def one_by_one(counts, capacity):
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else capacity) - length)
    return sorted(capacity - r for r in rooms)


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_best_fit(seed):
    """The same sequences as placing one piece at a time: many lengths, and few with many equal pieces."""
    draw = random.Random(seed)
    capacity = draw.choice([20, 100])
    kinds = draw.randint(1, 4) if seed % 2 else draw.randint(5, 30)
    counts = {draw.randint(1, capacity): draw.randint(1, 40) for _ in range(kinds)}
    assert placed_by_plan(counts, capacity) == one_by_one(counts, capacity)


def test_equal_pieces_fill_one_sequence_after_the_other():
    assert len(placed_by_plan({11: 2, 4: 2, 3: 3}, 20)) == 2
    assert len(placed_by_plan({11: 2000, 4: 2000, 3: 3000}, 20)) == 2000


def test_plan_does_not_grow_with_the_counts():
    few, many = ({n: c * (n % 13 + 1) for n in range(1, 4097, 7)} for c in (10, 10_000_000))
    assert len(packing.plan_best_fit(many)) < 4 * len(packing.plan_best_fit(few)) < 40_000
