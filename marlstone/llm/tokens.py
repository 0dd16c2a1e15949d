"""Ids of public tokenizers, word by word.

Both tokenizers cut a text into words before they merge, so the ids of a text are the ids of its words in a
row.  Plain texts are cut by the tokenizer's own word pattern; others into larger chunks at white
space.  Words repeat; a task looks most of them up.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

from marlstone.llm.common import Lately, Recent, encoded, plain_pattern

_DOUBLE_SPACE = re.compile(r"\s\s|\x00")
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
# A full stop or comma between a letter or digit and a space is a token run of its own.
_STOP = re.compile(r"(?<=[A-Za-z0-9])([.,])(?= |$)")
_STOP_BYTES = re.compile(rb"(?<=[a-z0-9])([.,])(?=\s|$)")
MEMO_CHUNKS, MEMO_WORDS = 300_000, 1_000_000
# Texts of ASCII and Latin letters without odd white space: every edition of Unicode reads them alike.
PLAIN = re.compile("[\t-\r -~\xa1-\u024f]*")
# Fixed value: the word pattern that the byte-level pre-tokenizer of the library has built in.
# Runs of letters are most words, so they are tried first; no other branch matches where one begins.
BYTE_LEVEL_WORDS = r" ?[\p{L}]+|'(?:s|t|re|ve|m|ll|d)| ?[\p{N}]+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> list[str]:
    """The byte alphabet: visible Latin-1 characters stand for themselves, other bytes for the characters from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


BYTE_LETTERS = _byte_letters()
_SPELLED = dict(enumerate(BYTE_LETTERS))


def word_cutter(path: str):
    """The words of a plain text as the tokenizer cuts them, or none if it does more than that."""
    with open(path, encoding="utf-8") as source:
        spec = json.load(source)
    cut, form = spec["pre_tokenizer"] or {}, spec["normalizer"] or {}
    if cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut["add_prefix_space"] and not form:
        return plain_pattern(BYTE_LEVEL_WORDS).findall
    cuts = cut.get("pretokenizers", [])
    if [s["type"] for s in form.get("normalizers", [])] != ["NFC", "Replace", "Lowercase"] or (
            [c["type"] for c in cuts] != ["Split", "ByteLevel"]):
        return None
    split, byte_level = cuts
    if not split["invert"] or split["behavior"] != "Removed" or byte_level["add_prefix_space"] or byte_level["use_regex"]:
        return None
    words = plain_pattern(split["pattern"]["Regex"]).findall
    return lambda text: words(text.lower())


class ChunkEncoder:
    """Little-endian 32-bit ids of texts, as bytes."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = end_id.to_bytes(4, "little")
        self.memo = Recent(MEMO_CHUNKS)
        self.words = word_cutter(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.word_ids = Lately(self.ids_of_word, MEMO_WORDS)
        # A special token ends whatever stands before it, so it separates chunks encoded in one go.
        self.mark_id, mark = next(iter(self.tokenizer.get_added_tokens_decoder().items()))
        self.mark = mark.content

    def forget(self) -> None:
        """Drop the ids of words and chunks; the tokenizer stays."""
        for memo in (self.memo, self.word_ids):
            memo.clear()
            memo.before = {}

    def chunks(self, text: str | None) -> list:
        raise NotImplementedError

    def as_text(self, chunk) -> str:
        return chunk

    def learn(self, chunks: list) -> None:
        texts = [self.as_text(c) for c in chunks]
        rare = [k for k, t in enumerate(texts) if "<|" in t]
        if rare:
            for k in rare:
                ids = self.tokenizer.encode(texts[k], add_special_tokens=False).ids
                self.memo[chunks[k]] = np.array(ids, "<u4").tobytes()
            skip = set(rare)
            chunks, texts = zip(*[(c, t) for k, (c, t) in enumerate(zip(chunks, texts)) if k not in skip] or [((), ())])
        if not texts:
            return
        joined = self.tokenizer.encode_batch_fast([self.mark.join(texts) + self.mark], add_special_tokens=False)
        ids = np.array(joined[0].ids, "<u4")
        ends = np.flatnonzero(ids == self.mark_id).tolist()
        flat = ids.tobytes()
        begin = 0
        for chunk, end in zip(chunks, ends, strict=True):
            self.memo[chunk] = flat[4 * begin:4 * end]
            begin = end + 1

    def ids_of_word(self, word: str) -> bytes:
        """A word is what the merges work on: it needs the model only, spelled in its byte alphabet."""
        spelled = (word if word.isascii() else word.encode().decode("latin-1")).translate(_SPELLED)
        return array("I", [t.id for t in self.tokenize(spelled)]).tobytes()

    def encode(self, texts: list) -> list[bytes]:
        """Ids of each text and the end id."""
        out: list = [None] * len(texts)
        cut, chunks = {}, set()
        for k, text in enumerate(texts):
            if self.words and text and "<|" not in text and PLAIN.fullmatch(text):
                out[k] = b"".join(map(self.word_ids.__getitem__, self.words(text))) + self.end
            else:
                cut[k] = self.chunks(text)
                chunks.update(cut[k])
        memo = self.memo
        missing = memo.unseen(chunks)
        for k in range(0, len(missing), 4096):
            self.learn(missing[k:k + 4096])
        for k, parts in cut.items():
            out[k] = b"".join(map(memo.__getitem__, parts)) + self.end
        return out


class ByteBpe(ChunkEncoder):
    """Byte-level BPE: a word takes the one space before it along."""

    def chunks(self, text):
        if not text:
            return []
        if _DOUBLE_SPACE.search(text):
            # A single space between two other characters always begins a token.
            parts = _SAFE_CUT.split(text)
            return [parts[0], *[" " + p for p in parts[1:]]]
        # No white space runs: every space begins a token, every line end is one.
        cut = _STOP.sub("\0\\1", text).replace(" ", "\0 ").replace("\n", "\0\n\0")
        return cut.split("\0")


class WordBpe(ChunkEncoder):
    """BPE with word ends and lower case: white space only separates."""

    def chunks(self, text):
        return _STOP_BYTES.sub(rb" \1", encoded(text).lower()).split()

    def as_text(self, chunk):
        return chunk.decode()
