"""SentencePiece BPE with seeded merge-dropout, and the decoder that undoes it.

Merges are taken from an agenda, best score first and leftmost among equals.  A candidate
that comes up is skipped when the keyed hash of (seed, document, number of the chunk in it, place and length of the
merge) falls below the dropout rate.  So every occurrence of a word is segmented by itself, and each
segmentation is reproducible: no generator state, the same on every machine and in every retried task.
Whatever is skipped, the pieces spell the same text.

What comes up next depends on the answers so far only.  A short chunk keeps the list of its candidates and its
ids if none is skipped.  Some texts ask the hashes of all candidates of all their chunks at once; the chunks that
had a skip are then merged anew, side by side in arrays, and every candidate that comes up there asks its own hash.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import Recent, map_batches, per_process, table  # noqa: F401 (Recent: tests patch it here)

SPACE_MARK = "▁"
# Stands for a space mark that is itself part of the text; no valid text contains it.
OWN_MARK = "\ud800"
_RUNS = re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}]*")
_STOP = re.compile(r"(?<=[A-Za-z0-9])([.,])")
# The same, one pattern each: a search for a fixed character and a fixed replacement are quicker than a class and a group.
_STOPS = [(re.compile(rf"{c}(?<=[A-Za-z0-9]{c})"), "\0" + c[-1]) for c in (r"\.", ",")]
# Chunks of up to so many characters are merged side by side; places in them take six bits.  Longer ones use a heap each.
SHORT = 64
# Chunks go together by length, up to so many characters, and at most so many at a time.
_WIDTHS, ROWS = (5, 8, 11, 16, 64), 65_536
_NONE = np.int32(2**31 - 1)
# Texts are encoded together up to so many bytes; a longer one alone.
TEXT_BYTES = 1_000_000
# Chunks of these texts are looked up so many at a time.
LOOKED_UP = 262_144
DROPOUT = 0.1
SEED = 17
# Chunks whose candidates are kept before all are dropped and made anew.
KEPT_LISTS = 500_000
_ALL = 2**64 - 1
# Odd multipliers of the keyed hash.
_BY_CHUNK, _BY_PLACE, _SPREAD = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93


def skip_hash(key: int, place: int, length: int) -> int:
    """64 bits for one candidate merge of one occurrence; ``key`` stands for seed, document and chunk number."""
    x = (key ^ (place << 32 | length) * _BY_PLACE) & _ALL
    x = (x ^ x >> 32) * _SPREAD & _ALL
    x = (x ^ x >> 32) * _SPREAD & _ALL
    return x ^ x >> 32


class PieceModel:
    """Pieces of a model file by text and by id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if len(ids) > 1 << 16:
            raise ValueError("ids are stored in 16 bits; the model has more than 65,536 pieces")
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                                        or model.is_unused(i))]
        self.id = {model.id_to_piece(i): i for i in plain}
        self.score = {piece: model.get_score(i) for piece, i in self.id.items()}
        self.byte_id = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.spelling = [b""] * len(ids)
        for piece, i in self.id.items():
            self.spelling[i] = piece.replace(SPACE_MARK, " ").encode()
        for byte, i in self.byte_id.items():
            self.spelling[i] = bytes([byte])


class PairTable:
    """Symbols, which are characters and pieces by number, and what two of them merge to; 0 is any other character."""

    def __init__(self, model: PieceModel):
        names = sorted({*model.score, *(c for piece in model.score for c in piece)})
        number = {name: k for k, name in enumerate(names, 1)}
        self.length = np.array([0, *map(len, names)], np.uint64)
        self.ids = np.array([-1, *(model.id.get(name, -1) for name in names)], np.int32)
        # Equal scores are one rank, so that the leftmost comes first.
        falling = {score: k for k, score in enumerate(sorted(set(model.score.values()), reverse=True))}
        self.rank = np.array([0, *(falling.get(model.score.get(name), 0) for name in names)], np.int32)
        self.of_char = np.zeros(0x110000, np.int32)
        for name in names:
            if len(name) == 1:
                self.of_char[ord(name)] = number[name]
        pairs = [(number[piece[:k]] << 32 | number[piece[k:]], number[piece]) for piece in model.score
                 for k in range(1, len(piece)) if piece[:k] in number and piece[k:] in number]
        # A hash table; pairs whose slot is taken stand behind it, one after the other.
        self.shift = 64 - max(4, (4 * len(pairs)).bit_length())
        slots = 1 << 64 - self.shift
        self.key = np.zeros(slots + len(pairs), np.uint64)
        self.result = np.zeros(slots + len(pairs), np.int32)
        self.after = np.zeros(slots + len(pairs), np.int32)
        end = slots
        for key, result in pairs:
            at = (key * _BY_CHUNK & _ALL) >> self.shift
            if self.key[at]:
                while self.after[at]:
                    at = self.after[at]
                self.after[at] = end
                at, end = end, end + 1
            self.key[at], self.result[at] = key, result

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What each pair merges to, 0 where it does not."""
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at = (key * np.uint64(_BY_CHUNK) >> np.uint64(self.shift)).astype(np.int64)
        same = self.key[at] == key
        found = self.result[at] * same
        behind = self.after[at] * ~same
        todo = np.flatnonzero(behind)
        while todo.size:
            at = behind[todo]
            same = self.key[at] == key[todo]
            found[todo[same]] = self.result[at[same]]
            todo, at = todo[~same], at[~same]
            behind[todo] = self.after[at]
            todo = todo[behind[todo] > 0]
        return found


class Runs:
    """Runs of numbers in one array, each given by its start and its length."""

    def __init__(self, n: int, kind):
        self.parts, self.size = [np.empty(0, kind)], 0
        self.starts, self.counts = np.zeros(n, np.int64), np.zeros(n, np.int64)

    @property
    def flat(self) -> np.ndarray:
        if len(self.parts) > 1:
            self.parts = [np.concatenate(self.parts)]
        return self.parts[0]

    def put(self, which, flat: np.ndarray, starts, counts) -> None:
        """Runs of another array in place of some of these."""
        self.starts[which], self.counts[which] = starts + self.size, counts
        self.parts.append(flat)
        self.size += len(flat)

    def add(self, other: "Runs") -> None:
        """The runs of the other one behind these."""
        self.starts = np.concatenate((self.starts, other.starts + self.size))
        self.counts = np.concatenate((self.counts, other.counts))
        self.parts.append(other.flat)
        self.size += other.size

    def some(self, which: np.ndarray) -> "Runs":
        picked = Runs(0, self.flat.dtype)
        picked.parts, picked.size = [self.flat], self.size
        picked.starts, picked.counts = self.starts[which], self.counts[which]
        return picked

    def joined(self) -> np.ndarray:
        """All runs, one behind the other."""
        ends = self.counts.cumsum()
        at = np.repeat(self.starts - (ends - self.counts), self.counts)
        at += np.arange(len(at))
        return self.flat[at]


class Numbers(dict):
    """Chunks by number; ``new`` holds those not seen before."""

    def __init__(self):
        super().__init__()
        self.given, self.new = 0, []

    def __missing__(self, chunk: str) -> int:
        self.new.append(chunk)
        number = self[chunk] = self.given
        self.given += 1
        return number


class MergeDropout:
    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED):
        self.model = PieceModel(path)
        self.pairs = PairTable(self.model)
        self.below = int(dropout * 2**64)
        self.seed = seed
        self._forget()

    def _forget(self) -> None:
        # By the number of a chunk: candidates as 64-bit integers, and ids, both if none is skipped.
        self.numbers, self.candidates, self.ids = Numbers(), Runs(0, np.uint64), Runs(0, "<u2")

    @property
    def kept(self) -> int:
        return self.numbers.given

    @property
    def lists(self) -> dict[str, tuple[bytes, bytes]]:
        """Candidates and ids by chunk, to look at."""
        return {chunk: tuple(runs.some(np.array([k])).joined().tobytes() for runs in (self.candidates, self.ids))
                for chunk, k in self.numbers.items()}

    def chunks(self, text: str) -> list[str]:
        """Space mark and what follows it; no piece has a space mark behind another character."""
        if not text:
            return []
        text = SPACE_MARK + text.replace(SPACE_MARK, OWN_MARK).replace(" ", SPACE_MARK)
        if "\0" in text or SPACE_MARK * 2 in text or text[-1] == SPACE_MARK:
            return _RUNS.findall(text)
        # No piece holds a line end, or a stop behind a letter or digit, so nothing merges across.
        text = text.replace(SPACE_MARK, "\0" + SPACE_MARK).replace("\n", "\0\n\0")
        for stop, marked in _STOPS:
            text = stop.sub(marked, text)
        return text.split("\0")[1:]

    def _ids(self, parts: list[str]) -> np.ndarray:
        ids = array("H")
        for part in parts:
            known = self.model.id.get(part)
            if known is not None:
                ids.append(known)
            else:
                ids.extend(self.model.byte_id[b] for b in part.replace(OWN_MARK, SPACE_MARK).encode())
        return np.array(ids, "<u2")

    def _merged(self, chunks: list[str], keys: np.ndarray | None = None) -> tuple[Runs, Runs]:
        """Candidates and ids of short chunks, merged side by side; without keys nothing is skipped, with keys no candidates are listed."""
        candidates, ids = Runs(len(chunks), np.uint64), Runs(len(chunks), "<u2")
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        low = 0
        for high in _WIDTHS:
            which = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            for k in range(0, len(which), ROWS):
                some = which[k:k + ROWS]
                listed, counts = self._side_by_side([chunks[i] for i in some.tolist()], sizes[some], None if keys is None else keys[some], ids, some)
                candidates.put(some, listed, counts.cumsum() - counts, counts)
        return candidates, ids

    def _side_by_side(self, chunks, sizes, keys, ids, which) -> tuple[np.ndarray, np.ndarray]:
        """One merge or skip of every chunk at a time.

        Arrays have a row per place and a column per chunk; the agenda holds rank and place of what may merge
        there with its right neighbour.  Behind the places are two rows for the neighbours of first and last ones.
        """
        width, n = int(sizes.max()), len(chunks)
        symbols = np.zeros((width + 2, n), np.int32)
        begins = sizes.cumsum() - sizes
        column = np.repeat(np.arange(n), sizes)
        letters = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4")
        symbols[np.arange(len(letters)) - begins[column], column] = self.pairs.of_char[letters]
        result = np.zeros((width + 2, n), np.int32)
        result[:width - 1] = self.pairs(symbols[:width - 1].ravel(), symbols[1:width].ravel()).reshape(width - 1, n)
        places = np.arange(width + 2, dtype=np.int32)[:, None]
        agenda = np.where(result > 0, self.pairs.rank[result] << 6 | places, _NONE)
        right, left = np.repeat(places + 1, n, 1), np.repeat(places - 1, n, 1)
        left[0] = width + 1
        columns, found, asked = np.arange(n), [], []
        while True:
            best = agenda.min(0)
            busy = best != _NONE
            active = np.flatnonzero(busy)
            if len(active) < 0.75 * n:
                over = np.flatnonzero(~busy)
                self._write(symbols.take(over, 1), columns[over], chunks, sizes, ids, which)
                if not len(active):
                    break
                symbols, result, agenda, right, left = (x.take(active, 1) for x in (symbols, result, agenda, right, left))
                columns, best, n = columns[active], best[active], len(active)
                active = np.arange(n)
            else:
                best = best[active]
            flat = [x.reshape(-1) for x in (symbols, result, agenda, right, left)]
            symbol, merge, listed, next_, last = flat
            place = best & 63
            at = place * np.int64(n) + active
            joined = merge[at]
            code = (place.astype(np.uint64) << np.uint64(32) | self.pairs.length[joined]) * np.uint64(_BY_PLACE)
            if keys is None:
                found.append(columns[active])
                asked.append(code)
            elif self.below:
                skip = _spread(keys[columns[active]] ^ code) <= np.uint64(self.below - 1)
                listed[at[skip]] = _NONE
                go = ~skip
                active, place, at, joined = active[go], place[go], at[go], joined[go]
            gone = next_[at] * np.int64(n) + active
            symbol[at], symbol[gone], listed[gone] = joined, -1, _NONE
            end = next_[at] = next_[gone]
            end = end * np.int64(n) + active
            last[end] = place
            before = last[at]
            start = before * np.int64(n) + active
            both = self.pairs(np.concatenate((joined, symbol[start])), np.concatenate((symbol[end], joined)))
            ranks = np.where(both > 0, self.pairs.rank[both] << 6 | np.concatenate((place, before)), _NONE)
            merge[at], listed[at] = both[:len(at)], ranks[:len(at)]
            merge[start], listed[start] = both[len(at):], ranks[len(at):]
        if keys is not None or not found:
            return np.empty(0, np.uint64), np.zeros(len(chunks), np.int64)
        found, asked = np.concatenate(found), np.concatenate(asked)
        return asked[found.argsort(kind="stable")], np.bincount(found, minlength=len(chunks))

    def _write(self, symbols, columns, chunks, sizes, ids, which) -> None:
        """Ids of finished chunks; characters that are no pieces are spelled in bytes."""
        symbols = symbols[:-2].T
        own = (symbols >= 0) & (np.arange(symbols.shape[1]) < sizes[columns, None])
        numbers = self.pairs.ids[symbols[own]]
        counts = own.sum(1)
        ends = counts.cumsum()
        ids.put(which[columns], numbers.astype("<u2"), ends - counts, counts)
        strange = np.flatnonzero(numbers < 0)
        for k in np.unique(np.searchsorted(ends, strange, "right")).tolist():
            chunk = chunks[columns[k]]
            cuts = [*np.flatnonzero(own[k]).tolist(), len(chunk)]
            one = self._ids([chunk[a:b] for a, b in zip(cuts, cuts[1:])])
            ids.put(which[columns[k]], one, 0, len(one))

    def _heaped(self, chunk: str, skipped) -> list[str]:
        """Merges of a chunk of any length."""
        score = self.model.score
        parts: list[str | None] = list(chunk)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(-score[chunk[i:i + 2]], i, chunk[i:i + 2]) for i in range(n - 1) if chunk[i:i + 2] in score]
        heapq.heapify(agenda)
        while agenda:
            _, left, joined = heapq.heappop(agenda)
            part, right = parts[left], after[left]
            if part is None or right >= n or part + parts[right] != joined or skipped(left, joined):
                continue
            parts[left], parts[right] = joined, None
            end = after[left] = after[right]
            if end < n:
                before[end] = left
                if joined + parts[end] in score:
                    heapq.heappush(agenda, (-score[joined + parts[end]], left, joined + parts[end]))
            start = before[left]
            if start >= 0 and parts[start] + joined in score:
                heapq.heappush(agenda, (-score[parts[start] + joined], start, parts[start] + joined))
        return [part for part in parts if part is not None]

    def encode(self, text: str | None, variant: int = 0) -> bytes:
        """Ids of a text; ``variant`` stands for the document."""
        return self.encode_all([text], [variant])[0]

    def encode_all(self, texts: list[str | None], variants: list[int]) -> list[bytes]:
        """Ids of each text."""
        cut = [self.chunks(text or "") for text in texts]
        chunks = list(chain.from_iterable(cut))
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        ends = counts.cumsum()
        bases = np.array([(self.seed * _BY_PLACE + v) * _SPREAD & _ALL for v in variants], np.uint64)
        numbers = np.arange(len(chunks)) - np.repeat(ends - counts, counts)
        keys = np.repeat(bases, counts) + numbers.astype(np.uint64) * np.uint64(_BY_CHUNK)
        flat, sizes = [], [np.zeros(1, np.int64)]
        for k in range(0, len(chunks), LOOKED_UP):
            found = self._chunk_ids(chunks[k:k + LOOKED_UP], keys[k:k + LOOKED_UP])
            flat.append(found.joined().tobytes())
            sizes.append(found.counts)
        flat = b"".join(flat)
        cuts = (2 * np.concatenate(sizes).cumsum()[ends]).tolist()
        return [flat[a:b] for a, b in zip([0, *cuts], cuts)]

    def _chunk_ids(self, chunks: list[str], keys: np.ndarray) -> Runs:
        if self.numbers.given > KEPT_LISTS:
            self._forget()
        which = np.fromiter(map(self.numbers.__getitem__, chunks), np.int64, len(chunks))
        new, self.numbers.new = self.numbers.new, []
        long = [chunk for chunk in new if len(chunk) > SHORT]
        if new:
            candidates, ids = self._merged([chunk if len(chunk) <= SHORT else "" for chunk in new])
            self.candidates.add(candidates)
            self.ids.add(ids)
        out = self.ids.some(which)
        for chunk in long:
            del self.numbers[chunk]  # they are merged anew every time
        for i in [i for i, chunk in enumerate(chunks) if len(chunk) > SHORT] if long else ():
            key = int(keys[i])
            one = self._ids(self._heaped(
                chunks[i], lambda place, joined, key=key: skip_hash(key, place, len(joined)) < self.below))
            out.put(i, one, 0, len(one))
        if self.below:
            asked = self.candidates.some(which)
            sizes, asked = asked.counts, asked.joined()
            asked ^= np.repeat(keys, sizes)
            skips = np.flatnonzero(_spread(asked) <= np.uint64(self.below - 1))
            # Chunks with a skip are merged anew, each occurrence with its own answers.
            again = np.unique(np.searchsorted(sizes.cumsum(), skips, "right"))
            anew = self._merged([chunks[i] for i in again.tolist()], keys[again])[1]
            out.put(again, anew.flat, anew.starts, anew.counts)
        return out


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of ``skip_hash`` for keys that hold the candidate already."""
    for _ in range(2):
        x ^= x >> np.uint64(32)
        x *= np.uint64(_SPREAD)
    x ^= x >> np.uint64(32)
    return x


def decode(model: PieceModel, ids: bytes) -> str:
    spelled = b"".join(map(model.spelling.__getitem__, memoryview(ids).cast("H")))
    return spelled[1:].decode()  # without the space that every encoding begins with


def encode_pieces(
    docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = SEED,
    ident: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Identifier, text (null: empty), ``variant``, ``ids`` (16-bit little-endian) per row.

    A row's variant, a hash of its identifier (null: 0), and the place of a word in the text decide how
    it is segmented, so equal words come out differently within a document and between documents.  The model may
    have up to 65,536 pieces.  Without dropout the ids are those of the library, save that a space mark
    in the text itself is spelled in bytes and so survives.  Repeated rows give repeated results, an
    empty table none; other columns are not read.
    """
    def make():
        engine = per_process(("dropout", model, dropout, seed), lambda: MergeDropout(model, dropout, seed))

        def work(batch):
            texts, picks = batch.column(1), batch.column(2).to_pylist()
            ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
            out: list[bytes] = []
            while len(out) < len(picks):
                begin = len(out)
                before = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, before + TEXT_BYTES, "right")))
                out += engine.encode_all(texts.slice(begin, end - begin).to_pylist(), picks[begin:end])
            return {ident: batch.column(0), "text": texts, "variant": batch.column(2), "ids": pa.array(out, pa.binary())}

        return work

    variant = F.when(F.col(ident).isNull(), 0).otherwise(
        F.pmod(F.xxhash64(F.col(ident), F.lit(seed)), F.lit(2**31 - 1))).cast("int")
    rows = docs.select(F.col(ident), F.coalesce(F.col(text), F.lit("")).alias("text"), variant.alias("variant"))
    kind = docs.schema[ident].dataType.simpleString()
    return map_batches(rows, f"`{ident}` {kind}, text string, variant int, ids binary", make)


def decode_pieces(encoded_rows: DataFrame, model: str, ident: str = "doc_id") -> DataFrame:
    """Decode ``ids``; says whether the text came back, how many ids it took and their checksum."""
    def make():
        pieces = per_process(("pieces", model), lambda: PieceModel(model))

        def work(batch):
            texts, ids = batch.column(1), batch.column(3)
            same, crc, n = [], [], []
            for i in range(0, batch.num_rows, 64):
                for t, x in zip(texts.slice(i, 64).to_pylist(), ids.slice(i, 64).to_pylist()):
                    same.append(decode(pieces, x) == t)
                    crc.append(zlib.crc32(x))
                    n.append(len(x) // 2)
            return {ident: batch.column(0), "variant": batch.column(2), "n_tokens": n, "ids_crc32": crc, "lossless": same}

        return work

    kind = encoded_rows.schema[ident].dataType.simpleString()
    return map_batches(
        encoded_rows, f"`{ident}` {kind}, variant int, n_tokens long, ids_crc32 long, lossless boolean", make)


def op10_piece_dropout(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return decode_pieces(encode_pieces(table(spark, sf_dir, "documents"), model), model)
