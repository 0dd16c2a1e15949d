import itertools
import json
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marlstone.llm import automaton
from marlstone.llm.automaton import MergeAutomaton, WordEncoder, arc_labels, decode_ids, decoded_text, encode_texts

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(PATH)


def small(merges, alphabet="ab"):
    vocabulary = {c: i for i, c in enumerate(alphabet)}
    for u, v in merges:
        vocabulary[u + v] = len(vocabulary)
    return vocabulary, MergeAutomaton(vocabulary, merges)


def merge_by_rank(word, merges):
    """The definition: one merge after another, each from left to right."""
    parts = list(word)
    for u, v in merges:
        out, i = [], 0
        while i < len(parts):
            if parts[i:i + 2] == [u, v]:
                out.append(u + v)
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


@pytest.mark.parametrize("seed", range(12))
def test_random_merge_lists_against_the_definition(seed):
    draw = random.Random(seed)
    tokens, merges = ["a", "b", "c"], []
    while len(merges) < 14:
        pair = draw.choice(tokens), draw.choice(tokens)
        if "".join(pair) not in tokens:
            merges.append(pair)
            tokens.append("".join(pair))
    vocabulary, automaton = small(merges, "abc")
    names = {i: t for t, i in vocabulary.items()}
    for n in range(1, 8):
        for word in itertools.product("abc", repeat=n):
            assert [names[i] for i in automaton.encode("".join(word))] == merge_by_rank(word, merges)


def test_one_path_per_word():
    """Of all ways to spell a word only the one that BPE gives is a path."""
    merges = [("a", "b"), ("b", "a"), ("ab", "a"), ("a", "a"), ("aa", "ba"), ("b", "ab")]
    vocabulary, automaton = small(merges)
    names = {i: t for t, i in vocabulary.items()}

    def spellings(word):
        if not word:
            yield []
        for k in range(1, len(word) + 1):
            if word[:k] in vocabulary:
                for rest in spellings(word[k:]):
                    yield [word[:k], *rest]

    for n in range(1, 9):
        for letters in itertools.product("ab", repeat=n):
            accepted = []
            for tokens in spellings("".join(letters)):
                state, ok = 0, True
                for t in tokens:
                    ok = ok and vocabulary[t] in automaton.behind and automaton.has_arc(state, vocabulary[t])
                    state = automaton.behind.get(vocabulary[t], 0)
                accepted += [tokens] if ok else []
            assert accepted == [merge_by_rank(letters, merges)]
            assert [names[i] for i in automaton.encode("".join(letters))] == accepted[0]


def test_states_stay_below_merges(encoder):
    assert len(encoder.automaton.lost) <= len(encoder.automaton.made) + 1


def test_two_merges_to_one_token_are_refused():
    with pytest.raises(ValueError):
        small([("a", "b"), ("b", "a"), ("ab", "a"), ("a", "ba")])


ODD = [
    None, "", "  \n\t", "a<|endoftext|>B<|ENDOFTEXT|>c <|startoftext|>", "ΑΣ ΟΔΟΣ", "é ́x", "İstanbul", "a\x1cb\x85c d e",
    "a" * 5000, "don't we'LL 'S 12345 o'r", "日本語テスト 🎉🎉", "\x00\x01", "ﬁ ǅ ẞ", "word, word. WORD", "ée ́", "<|", "x" * 99 + "y" * 300,
]


def test_equals_the_library(library, encoder):
    draw = random.Random(3)
    texts = ODD + ["".join(draw.choice("abcdeilnorst thein'.,S9") for _ in range(draw.randint(1, 60))) for _ in range(3000)]
    texts += ["".join(chr(draw.choice([draw.randint(0, 0x2FF), draw.randint(0x300, 0xD7FF), draw.randint(0x1F300, 0x1FFFF)]))
                      for _ in range(draw.randint(1, 12))) for _ in range(2000)]
    texts += ["".join(chr(draw.choice([draw.randint(9, 0x24F), draw.randint(0x41, 0x7A), 0x20])) for _ in range(draw.randint(1, 30)))
              for _ in range(4000)]
    labels = arc_labels(PATH)
    for text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert encoder.ids(text) == ids, text
        assert decoded_text(ids, labels) == library.decode(ids, skip_special_tokens=False)


def test_whole_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r["doc_id"]: r for r in decode_ids(encode_texts(docs, PATH), PATH).collect()}
    texts = docs.collect()
    assert len(rows) == len(texts)
    for r in texts:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert rows[r["doc_id"]]["ids"] == ids
        assert rows[r["doc_id"]]["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_rows_stay_as_they_are(spark):
    rows = [(1, "same text"), (1, "same text"), (None, "x"), (2, None), (3, ""), (4, "word " * 50_000)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS).select(
        "*", F.lit("z").alias("ids"), F.lit(1).alias("decoded"))
    got = decode_ids(encode_texts(df, PATH), PATH).collect()
    assert sorted((r["doc_id"] or 0, len(r["ids"])) for r in got) == [(0, 1), (1, 2), (1, 2), (2, 0), (3, 0), (4, 50_000)]
    assert {r["doc_id"]: r["decoded"] for r in got}[1] == "same</w> text</w>"


def test_empty_table(spark):
    assert decode_ids(encode_texts(spark.createDataFrame([], DOCS), PATH), PATH).collect() == []


def test_table_of_arcs_is_emptied_when_full(monkeypatch, library):
    monkeypatch.setattr("marlstone.llm.automaton.TABLE_ARCS", 50)
    encoder = WordEncoder(PATH)
    text = " ".join(list(json.load(open(PATH))["model"]["vocab"])[3000:3300])
    assert encoder.ids(text) == library.encode(text, add_special_tokens=False).ids
    assert encoder.automaton.tested <= 50


def test_rows_are_decoded_in_columns():
    labels = automaton.arc_labels(PATH)
    rows = [[], [320, 49406, 5], [7], [], list(range(0, 49408, 97))]
    flat = pa.array([i for row in rows for i in row], pa.int32())
    ends = np.cumsum([0, *map(len, rows)])
    got = automaton.decoded_texts(flat, ends, automaton._label_column(labels))
    assert got.to_pylist() == [decoded_text(row, labels) for row in rows]
    with pytest.raises(KeyError):
        automaton.decoded_texts(pa.array([1], pa.int32()), [0, 1], automaton._label_column({0: "a", 2: "b"}))
