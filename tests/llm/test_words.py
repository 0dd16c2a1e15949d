"""The quicker word patterns against the library they stand for, and the memory of recent results."""

import json
import random
import re

import public_tokenizers
import pyarrow as pa
import pytest
import regex

from marlstone.llm.common import Recent, map_batches, plain_pattern
from marlstone.llm.tokens import BYTE_LEVEL_WORDS, WordBpe


def test_plain_patterns_cut_as_the_library_does():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as source:
        word_pattern = json.load(source)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    letters = [chr(c) for c in (*range(9, 14), *range(32, 127), *range(0xA0, 0x250))]
    draw = random.Random(5)
    texts = ["".join(letters), "it's we'll 'S !'s a-1² xİy"]
    texts += ["".join(draw.choices(letters + [" "] * 90 + ["'"] * 30 + list("stmdrevl\n") * 9, k=400)) for _ in range(300)]
    for pattern in (word_pattern, BYTE_LEVEL_WORDS):
        quick, library = plain_pattern(pattern), regex.compile(pattern)
        assert isinstance(quick, re.Pattern)
        for text in texts:
            assert quick.findall(text) == library.findall(text)
            assert quick.findall(text.lower()) == library.findall(text.lower())
    assert isinstance(plain_pattern(r"\p{Lu}+"), regex.Pattern)


def test_frequent_keys_stay():
    memo, made = Recent(20), []
    for k in range(200):
        for key in memo.unseen({"often", k, k + 1000}):
            memo[key] = key
            made.append(key)
        assert memo["often"] == "often" and memo[k] == k and len(memo) + len(memo.before) <= 24
    assert made.count("often") == 1 and len(made) == 401


def test_packing_tasks_leave_no_words_behind(spark, documents, prose):
    from marlstone.llm.packing import tokenized_pieces

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = documents([(k, prose(k, 50)) for k in range(20)])

    def look(batches):
        import sys

        for _ in batches:
            pass
        for encoder in sys.__dict__.get("_llm_kept", {}).values():
            left = sum(len(x) + len(x.before) for x in (encoder.memo, encoder.word_ids)) if hasattr(encoder, "word_ids") else 0
            yield pa.RecordBatch.from_pydict({"n": pa.array([left], pa.int64())})

    assert tokenized_pieces(rows, path).count() >= 20
    left = [r.n for r in spark.range(0, 64, 1, 16).mapInArrow(look, "n long").collect()]
    assert left and not any(left)
    engine = WordBpe(path, 1)
    first = engine.encode(["some words", "and中 others"])
    assert engine.word_ids
    engine.forget()
    assert not (engine.word_ids or engine.word_ids.before or engine.memo or engine.memo.before)
    assert engine.encode(["some words", "and中 others"]) == first


def test_a_task_says_when_it_ends(spark):
    def make():
        rows = []

        def work(batch):
            rows.append(batch.num_rows)
            return {"n": batch.column(0)}

        def end():
            assert sum(rows) == 5
            raise ValueError("end was called")

        work.end = end
        return work

    with pytest.raises(Exception, match="end was called"):
        map_batches(spark.range(0, 5, 1, 1), "n long", make).collect()
