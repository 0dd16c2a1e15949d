import numpy as np
import public_tokenizers as P
from sentencepiece import SentencePieceProcessor

from marlstone.llm import piece_dropout as pd

MODEL = P.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "  a  b ", "Hello world.\nNext line", "é ü 漢字 😀", "\x00\t\r\n", "x" * 3000, " lead", "trail ", "a\n b\n\nc",
         "<s> </s> <unk> <0x41>", "don't stop"]


def ids(raw):
    return np.frombuffer(raw, "<u2").tolist()


def test_without_dropout_it_is_the_library(prose):
    library, engine = SentencePieceProcessor(model_file=MODEL), pd.MergeDropout(MODEL, 0.0)
    for text in [*TEXTS, *(prose(i, 40).title() for i in range(20))]:
        assert ids(engine.encode(text)) == library.encode(text or "")


def test_both_agendas_agree(prose, monkeypatch):
    texts = [*TEXTS, prose(3, 300)]
    listed = [pd.MergeDropout(MODEL, 0.2).encode(t, 1) for t in texts]
    monkeypatch.setattr(pd, "SHORT", 3)
    assert [pd.MergeDropout(MODEL, 0.2).encode(t, 1) for t in texts] == listed


def test_chunks_are_looked_up_in_one_go_and_long_ones_are_not_kept(prose, monkeypatch):
    texts = [*TEXTS, "y" * 70 + " é漢 " + "y" * 70, prose(4, 60)]
    expected = [pd.MergeDropout(MODEL, 0.2).encode(t, 1) for t in texts]
    engine = pd.MergeDropout(MODEL, 0.2)
    # A default for each chunk was half of what a lookup took.
    monkeypatch.setattr(pd.Recent, "get", None, raising=False)
    assert [engine.encode_all(texts, [1] * len(texts)) for _ in range(2)] == [expected] * 2
    assert max(map(len, engine.lists)) <= pd.SHORT


def test_no_piece_joins_across_a_cut():
    assert not any("\n" in p or pd._STOP.search(p) for p in pd.PieceModel(MODEL).id)


def test_dropout_varies_and_decodes(prose):
    engine = pd.MergeDropout(MODEL, 0.3)
    for text in [*TEXTS, "own ▁ mark▁▁", prose(1, 200)]:
        for variant in range(3):
            assert pd.decode(engine.model, engine.encode(text, variant)) == (text or "")
    text = prose(2, 200)
    versions = {engine.encode(text, v) for v in range(4)}
    assert len(versions) == 4
    assert engine.encode(text, 2) == pd.MergeDropout(MODEL, 0.3).encode(text, 2) != pd.MergeDropout(MODEL, 0.3, 5).encode(text, 2)
    assert all(len(v) > len(pd.MergeDropout(MODEL, 0.0).encode(text)) for v in versions)
    every = pd.MergeDropout(MODEL, 1.0).encode("abc d")
    assert len(ids(every)) == 6


def test_table(spark, documents):
    rows = [*enumerate(TEXTS), (None, "no id"), (3, "again"), (3, "again")]
    docs = documents(rows, ["ids", "variant", "lossless"])
    got = pd.decode_pieces(pd.encode_pieces(docs, MODEL), MODEL).collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (0, 1)} == {0}
    assert len({tuple(r) for r in got if r.doc_id == 3}) == 2 and {r.variant for r in got} > {0}
    assert pd.decode_pieces(pd.encode_pieces(documents([]), MODEL), MODEL).count() == 0


def slow(model, text, variant, dropout, seed=pd.SEED):
    """Merge by merge over plain lists, with the hash written out in its own words."""
    mask, out = (1 << 64) - 1, []

    def bits(key, place, length):
        x = (key ^ ((place * 2**32 + length) * pd._BY_PLACE)) % 2**64
        for _ in range(2):
            x = ((x ^ (x >> 32)) * pd._SPREAD) % 2**64
        return x ^ (x >> 32)

    chunks = pd.MergeDropout(MODEL, 0.0).chunks(text)
    for number, chunk in enumerate(chunks):
        key = (((seed * pd._BY_PLACE + variant) * pd._SPREAD) + number * pd._BY_CHUNK) & mask
        parts, places, refused = list(chunk), list(range(len(chunk))), set()
        while True:
            candidates = [(-model.score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
                          if a + b in model.score and (places[i], a + b, a) not in refused]
            if not candidates:
                break
            _, i = min(candidates)
            joined = parts[i] + parts[i + 1]
            if bits(key, places[i], len(joined)) < int(dropout * 2**64):
                refused.add((places[i], joined, parts[i]))
                continue
            parts[i:i + 2], places[i:i + 2] = [joined], [places[i]]
        for part in parts:
            known = model.id.get(part)
            out += [known] if known is not None else [model.byte_id[b] for b in part.replace(pd.OWN_MARK, "▁").encode()]
    return out


def test_against_a_slow_version_with_dropout(prose):
    engine = pd.MergeDropout(MODEL, 0.25)
    for variant in (0, 7, 2**31 - 2):
        for text in [*TEXTS[1:7], prose(4, 60).title(), "tokenization " * 30]:
            assert ids(engine.encode(text, variant)) == slow(engine.model, text, variant, 0.25)


def test_every_candidate_of_every_occurrence_is_skipped_one_time_in_ten():
    engine, plain = pd.MergeDropout(MODEL, 0.1), pd.MergeDropout(MODEL, 0.0)
    whole = ids(plain.encode("the"))
    assert len(whole) == 1
    candidates = np.frombuffer(plain.lists["▁the"][0], "<u8").tolist()
    for code in candidates:
        asked = [int(pd._spread(np.array([(v * pd._SPREAD + n * pd._BY_CHUNK) & pd._ALL ^ code], np.uint64))[0]) < engine.below
                 for v in range(200) for n in range(20)]
        assert 0.08 < np.mean(asked) < 0.12
    # Within a document about one occurrence in ten and per candidate comes out differently, and not all alike.
    text, n = "the " * 200, len(candidates)
    changed, kinds = 0, set()
    for v in range(100):
        got = ids(engine.encode(text.rstrip(), v))
        changed += len(got) > 200
        kinds.add(tuple(got))
    assert changed == 100 and len(kinds) == 100 and n >= 2


def test_lists_are_dropped_when_full(prose, monkeypatch):
    texts = [prose(i, 100) for i in range(6)]
    expected = [pd.MergeDropout(MODEL, 0.3).encode(t, 3) for t in texts]
    monkeypatch.setattr(pd, "KEPT_LISTS", 40)
    engine = pd.MergeDropout(MODEL, 0.3)
    assert [engine.encode(t, 3) for t in texts] == expected and engine.kept < 1000


def test_occurrences_with_a_skip_are_merged_side_by_side(prose, monkeypatch):
    texts = [*TEXTS, *(prose(i, 60).title() for i in range(8)), "z" * 20, "the " * 300, "ab▁c" * 9]
    variants = [k * 101 for k in range(len(texts))]
    for dropout in (0.0, 0.3, 1.0):
        engine = pd.MergeDropout(MODEL, dropout)
        calls, merged = [], engine._merged
        monkeypatch.setattr(engine, "_merged", lambda chunks, keys=None: calls.append(len(chunks)) or merged(chunks, keys))
        got = engine.encode_all(texts, variants)
        # All texts together take one call for the unseen chunks and one for those with a skip.
        assert len(calls) == (2 if dropout else 1) and sum(calls) > 50
        assert [ids(one) for one in got] == [slow(engine.model, t or "", v, dropout) for t, v in zip(texts, variants)]
        monkeypatch.setattr(pd, "ROWS", 40)
        assert pd.MergeDropout(MODEL, dropout).encode_all(texts, variants) == got
        monkeypatch.undo()


def test_merges_of_two_symbols(prose):
    model = pd.PieceModel(MODEL)
    pairs = pd.PairTable(model)
    number = {int(i): k for k, i in enumerate(pairs.ids) if i >= 0}
    names = [p for p in model.id if len(p) > 1][:3000] + [p for p in model.id if len(p) == 1][:500]
    cuts = [(p[:k], p[k:]) for p in names for k in range(1, len(p))] + list(zip(names, reversed(names)))
    cuts = [(a, b) for a, b in cuts if a in model.id and b in model.id]
    left, right = (np.array([number[model.id[c[k]]] for c in cuts], np.int32) for k in (0, 1))
    assert pairs.ids[pairs(left, right)].tolist() == [model.id.get(a + b, -1) if a + b in model.score else -1 for a, b in cuts]


def test_known_chunks_take_no_step_of_python_each(prose):
    texts = [prose(k, 300) + " \u4e2d\u6587\U0001f600 a.b,c" for k in range(6)] + [None, "", "x" * 200]
    engine = pd.MergeDropout(MODEL)
    expected = [pd.MergeDropout(MODEL).encode(t, v) for v, t in enumerate(texts)]
    assert engine.encode_all(texts, list(range(len(texts)))) == expected
    # Numbers of chunks lead to runs in two flat arrays; nothing is kept as an object per chunk but its number.
    known = engine.kept
    assert len(engine.candidates.counts) == len(engine.ids.counts) == known and set(map(type, engine.numbers.values())) == {int}
    assert engine.encode_all(texts, list(range(len(texts)))) == expected and engine.kept == known + 1
    assert engine.encode_all([], []) == [] and engine.encode_all([None, ""], [1, 2]) == [b"", b""]


def test_runs_are_replaced_and_joined():
    runs = pd.Runs(3, np.int64)
    runs.put(np.array([2, 0]), np.array([7, 8, 9]), np.array([0, 1]), np.array([1, 2]))
    assert runs.joined().tolist() == [8, 9, 7]
    other = pd.Runs(1, np.int64)
    other.put(0, np.array([5, 6]), 0, 2)
    runs.add(other)
    some = runs.some(np.array([3, 0, 3]))
    some.put(1, np.array([1]), 0, 1)
    assert some.joined().tolist() == [5, 6, 1, 5, 6] and runs.joined().tolist() == [8, 9, 7, 5, 6]
