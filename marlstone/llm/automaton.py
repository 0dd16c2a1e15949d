"""BPE as a deterministic automaton over token ids, built merge by merge.

The automaton accepts exactly the token sequences that BPE produces, so a word has one path
through it.  It starts with one state and an arc for every base symbol.  Each merge
(u, v) -> w then adds its gadget:

* an arc w goes wherever an arc u goes, and leads to the state the arc v leads to now;
* the state behind u loses its arc v, because u v is from now on written w.  A state that
  other arcs lead to as well is copied first.

States hold differences only: the arcs that gadgets took away, by the number of the gadget, and the state
they were copied from.  Copies of the states behind one token share one such list; each counts the
gadgets up to its own last number.  That is all an arc test needs, and there are at most as many states
as merges.  Tests are kept in a table, state by state, as words use them.

A word is encoded by following arcs that its next characters spell, the longest first.  Every prefix of a
word has one path, so a place has one state however it was reached: a place without a way on is
left for good, and no place is searched twice.  Decoding writes the label of each arc.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import Memo, Recent, encoded, map_batches, per_process, plain_pattern, table

MEMO_WORDS, MEMO_CHUNKS = 250_000, 50_000
# Longer chunks and words are not kept.
KEPT_LENGTH = 100
# Texts of ASCII and Latin letters: nothing to compose, and every edition of Unicode reads them alike.
_PLAIN = re.compile("[\t-\r -~\xa0-\u024f]*")
TABLE_ARCS = 400_000
# Rows whose ids a task holds as Python integers at a time.
ROWS = 64


class MergeAutomaton:
    """States, arcs and labels of one merge list."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str = ""):
        self.end = end
        self.left: dict[int, int] = {}
        self.made: dict[int, int] = {}
        # By state: what it was copied from, lost arcs, the last gadget that counts, the token it stands behind.
        self.copied_from = [-1]
        self.lost: list[dict[int, int]] = [{}]
        self.upto = [len(merges)]
        self.owner = [-1]
        self.shared = [True]
        results = {vocabulary[u + v] for u, v in merges}
        self.base = {t: i for t, i in vocabulary.items() if i not in results}
        self.behind = dict.fromkeys(self.base.values(), 0)
        self.seen: set[int] = set()
        for number, (u, v) in enumerate(merges):
            self._add_gadget(number, vocabulary[u], vocabulary[v], vocabulary[u + v])
        self._spell(vocabulary)
        self.table: list[dict[int, bool]] = [{} for _ in self.lost]
        self.tested = 0

    def _add_gadget(self, number: int, u: int, v: int, w: int) -> None:
        if w in self.seen:
            raise ValueError(f"two merges make token {w}")
        self.seen.add(w)
        if u not in self.behind or v not in self.behind or not self.has_arc(self.behind[u], v):
            return  # an earlier merge takes the parts apart: no word ever gets to w
        self.left[w], self.made[w] = u, number
        self.behind[w] = self.behind[v]
        self.shared[self.behind[v]] = True
        state = self.behind[u]
        if self.shared[state]:
            own = self.owner[state] == u
            if own:
                self.upto[state] = number - 1
            self.copied_from.append(self.copied_from[state] if own else state)
            self.lost.append(self.lost[state] if own else {})
            self.upto.append(self.upto[0])
            self.owner.append(u)
            self.shared.append(False)
            state = self.behind[u] = len(self.lost) - 1
        self.lost[state][v] = number

    def _spell(self, vocabulary: dict[str, int]) -> None:
        """The arcs by the symbols that spell them: nested pairs of a token, if one ends here, and what follows."""
        self.root: list = [None, {}]
        for token, number in vocabulary.items():
            if number not in self.behind:
                continue
            node = self.root
            for symbol in self.symbols(token):
                node = node[1].setdefault(symbol, [None, {}])
            node[0] = number

    def symbols(self, spelled: str) -> list[str]:
        """Characters, the last one together with the mark of a word's end."""
        if self.end and spelled.endswith(self.end):
            stem = spelled[:-len(self.end)]
            return [*stem[:-1], stem[-1:] + self.end]
        return list(spelled)

    def has_arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow in ``state``: it, or a left part of it before it was whole, was not lost."""
        chain = []
        while state >= 0:
            chain.append((self.lost[state].get, self.upto[state]))
            state = self.copied_from[state]
        bound = self.upto[0]
        while True:
            for number_of, upto in chain:
                number = number_of(token)
                if number is not None and number <= bound and number <= upto:
                    return False
            if token not in self.left:
                return True
            bound, token = self.made[token], self.left[token]

    def _known(self, state: int, token: int) -> bool:
        if self.tested >= TABLE_ARCS:
            self.table, self.tested = [{} for _ in self.lost], 0
        self.tested += 1
        found = self.table[state][token] = self.has_arc(state, token)
        return found

    def encode(self, word: str) -> tuple[int, ...]:
        """Ids of one pre-split word; its mark of the end is added here."""
        symbols = self.symbols(word + self.end)
        n, first = len(symbols), self.root[1]
        i, state, ids, before, dead = 0, 0, [], [], set()
        while i < n:
            follow, spelled = first, []
            for j in range(i, n):
                node = follow.get(symbols[j])
                if node is None:
                    break
                token, follow = node
                if token is not None:
                    spelled.append((token, j + 1))
            while True:
                row = self.table[state]
                while spelled:
                    token, j = spelled.pop()
                    open_ = row.get(token)
                    if open_ is None:
                        open_ = self._known(state, token)
                        row = self.table[state]
                    if open_ and j not in dead:
                        break
                else:
                    if not before:
                        raise ValueError(f"no base symbols for {word!r}")
                    dead.add(i)
                    i, state, spelled = before.pop()
                    ids.pop()
                    continue
                break
            before.append((i, state, spelled))
            ids.append(token)
            i, state = j, self.behind[token]
        return tuple(ids)


class WordEncoder:
    """Ids of whole texts: cut at white space, pre-split, then the automaton.

    Plain texts are lower-cased and cut by the tokenizer's word pattern.  Others go chunk by chunk
    (white space only separates words here) through the library's normaliser and word split, added
    tokens first.  Words and chunks repeat and are looked up.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = MergeAutomaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in self.added) + ")")
        # Only the text forms are taken from the library: its normaliser and its word split.
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.plain_words = self._plain_split(spec)
        self.letters = _byte_letters()
        self.chunk_ids = Memo(self._chunk, MEMO_CHUNKS)
        self.word_ids = Recent(MEMO_WORDS)

    @staticmethod
    def _plain_split(spec: dict):
        """The word pattern, where plain texts need no more than lower case and this pattern."""
        steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
            return None
        split, bytelevel = cuts
        if not split["invert"] or split["behavior"] != "Removed" or bytelevel["add_prefix_space"] or bytelevel["use_regex"]:
            return None
        return plain_pattern(split["pattern"]["Regex"]).findall

    def _encode(self, word: str) -> tuple[int, ...]:
        if not word.isascii():
            word = "".join(map(self.letters.__getitem__, word.encode()))
        return self.automaton.encode(word)

    def _chunk(self, chunk: bytes) -> tuple[int, ...]:
        ids: list[int] = []
        for part in self.cut.split(chunk.decode()):
            if part in self.added:
                ids.append(self.added[part])
            elif part:
                for word, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part)):
                    ids += self.automaton.encode(word)
        return tuple(ids)

    def ids(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        if self.plain_words and _PLAIN.fullmatch(text) and "<|" not in text:
            words, known = self.plain_words(text.lower()), self.word_ids
            new = known.unseen(set(words))
            for word in new:
                known[word] = self._encode(word)
            out = list(chain.from_iterable(map(known.__getitem__, words)))
            for word in new:
                if len(word) >= KEPT_LENGTH:
                    del known[word]
            return out
        for chunk in encoded(text).split():
            out += self.chunk_ids[chunk] if len(chunk) < KEPT_LENGTH else self._chunk(chunk)
        return out


def _byte_letters() -> list[str]:
    """The byte alphabet: visible Latin-1 characters stand for themselves, other bytes for the characters from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def arc_labels(path: str) -> dict[int, str]:
    """What each arc writes, added tokens included."""
    with open(path, encoding="utf-8") as source:
        spec = json.load(source)
    if spec["decoder"] is not None:
        raise ValueError("labels of this tokenizer are not its decoded text")
    return {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}


def _label_column(labels: dict[int, str]) -> pa.Array:
    """By id; ids without a label are null."""
    return pa.array([labels.get(i) for i in range(max(labels) + 1)], pa.string())


def decoded_text(ids, labels: dict[int, str]) -> str:
    """The labels of the arcs; without a decoder of its own, the tokenizer sets them one space apart."""
    return " ".join(map(labels.__getitem__, ids))


def decoded_texts(ids: pa.Array, ends: np.ndarray, labels: pa.Array) -> pa.Array:
    """``decoded_text`` of many rows, the ids of each up to its end."""
    written = labels.take(ids)
    if written.null_count:
        raise KeyError("ids without a label")
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), written), " ")


def _encoder(path: str) -> WordEncoder:
    return per_process(("merge_automaton", path), lambda: WordEncoder(path))


def _by_rows(column: pa.Array, f) -> pa.Array:
    return pa.concat_arrays([f(column.slice(i, ROWS)) for i in range(0, len(column), ROWS)])


def encode_texts(docs: DataFrame, tokenizer: str, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``ident`` and ``ids`` (array of int) of every row, without start, end or padding.

    A null or empty text, or one of white space, has no ids.  Texts of any length are encoded
    whole.  Rows stay as they are, repeated ones and null identifiers too; an empty table gives no
    rows; other columns are not read.  The tokenizer must be a BPE without dropout, unknown token or
    byte fallback whose words end at white space, with a mark of the word's end or without.
    """
    def make():
        encoder = _encoder(tokenizer)

        def encoded_rows(texts):
            return pa.array([encoder.ids(t) for t in texts.to_pylist()], pa.list_(pa.int32()))

        def work(batch):
            return {ident: batch.column(0), "ids": _by_rows(batch.column(1), encoded_rows)}

        return work

    kind = docs.schema[ident].dataType.simpleString()
    return map_batches(docs.select(ident, text), f"`{ident}` {kind}, ids array<int>", make)


def decode_ids(rows: DataFrame, tokenizer: str, ident: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``ident``, ``ids`` and the ``decoded`` text of every row; null ids count as none."""
    def make():
        labels = per_process(("arc_labels", tokenizer), lambda: _label_column(arc_labels(tokenizer)))

        def decoded_rows(lists):
            ends = np.cumsum([0, *lists.value_lengths().fill_null(0).to_numpy()])
            return decoded_texts(lists.flatten(), ends, labels)

        def work(batch):
            lists = batch.column(1)
            return {ident: batch.column(0), ids: lists, "decoded": _by_rows(lists, decoded_rows)}

        return work

    kind = rows.schema[ident].dataType.simpleString()
    return map_batches(rows.select(ident, ids), f"`{ident}` {kind}, `{ids}` array<int>, decoded string", make)


def op12_merge_automaton(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    decoded = decode_ids(encode_texts(table(spark, sf_dir, "documents"), path), path)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
