"""SentencePiece encoding and decoding with an Aho-Corasick automaton and one Viterbi pass.

The automaton holds all pieces; at each position of a text its output links
give every piece that ends there, and each relaxes that position:

* a unigram model keeps the piece with the best summed score;
* a BPE model (as in the public 32k file) keeps the piece that merging would
  have left there.  Every prefix has one BPE encoding, and the piece that ends
  it is the one that BPE leaves side by side with the last piece before it;
  pairs are decided once and remembered.

Characters that no piece covers become byte pieces, or the unknown piece in
models without them.  Where no piece holds a word mark after another
character, encodings of words are independent, so each task encodes a word
once and looks it up after that, in a memo of bounded size.

The driver reads the model file (its path is a parameter) and ships pieces
and scores to the tasks; a model is bounded by its vocabulary.

Edge cases: null and empty texts have no tokens and decode to empty texts;
repeated rows are encoded one by one; an empty table gives an empty result;
other columns are kept, but for those that the result columns replace.  A text that holds U+2581 itself decodes to a space
there, as in the reference library.

Scale: no shuffle; texts stream through in Arrow batches.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

__all__ = ["MODEL", "load_model", "Codec", "encode", "decode"]

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MEMO = 300_000
#: Texts that a task encodes before it hands on their ids.
ROWS = 500
UNKNOWN_PENALTY = 10.0


def load_model(path: str = MODEL) -> dict:
    """Pieces, scores, kinds and flags of a SentencePiece model file as plain values."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("only models with identity normalisation are supported")
    kind = {1: "unigram", 2: "bpe"}[model.trainer_spec.model_type]
    return {"kind": kind, "prefix": model.normalizer_spec.add_dummy_prefix,
            "pieces": tuple((p.piece, p.score, p.type) for p in model.pieces)}


class Memo(dict):
    """The last ``MEMO`` words met, or twice as many, with their ids; words looked up again stay."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.make(word)
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found


class Codec:
    """Encoder and decoder of one model; built once in each Python worker."""

    def __init__(self, model: dict):
        self.kind, self.prefix = model["kind"], model["prefix"]
        self.pieces = model["pieces"]
        normal = [(i, p, s) for i, (p, s, t) in enumerate(self.pieces) if t in (1, 4)]
        self.score = {p: s for _, p, s in normal}
        self.id = {p: i for i, p, _ in normal}
        self.byte = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(self.pieces) if t == 6}
        self.unknown = next((i for i, (_, _, t) in enumerate(self.pieces) if t == 2), 0)
        self.floor = min(self.score.values(), default=0.0) - UNKNOWN_PENALTY
        self.halves: dict[str, tuple[str, str]] = {}
        self.automaton = ahocorasick.Automaton()
        for i, p, s in normal:
            if self.kind == "unigram" or self.merge(p) == [p]:  # BPE never leaves other pieces
                self.automaton.add_word(p, (i, len(p), s))
        self.automaton.make_automaton()
        inner = any(MARK in p.lstrip(MARK) for p in self.id)
        newline = any("\n" in p for p in self.id)
        self.words = None if inner else re.compile(
            f"{MARK}+[^{MARK}]*|[^{MARK}]+" if newline else f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
        self.known = {p for p in self.id if len(p) == 1}
        self.beside: dict[int, bool] = {}
        self.memo = Memo(lambda word: array("i", self.word_ids(word)).tobytes())
        self.out = [b"" if t in (2, 3) else bytes([int(p[3:5], 16)]) if t == 6 else p.replace(MARK, " ").encode()
                    for p, _, t in self.pieces]

    def merge(self, text: str) -> list[str]:
        """BPE by its definition: of adjacent pairs that form a piece, merge the best, leftmost first."""
        part, after = list(text), list(range(1, len(text) + 1))
        before = list(range(-1, len(text) - 1))
        queue: list[tuple[float, int, str, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(part) and (s := self.score.get(part[i] + part[j])) is not None:
                heapq.heappush(queue, (-s, i, part[i] + part[j], j))

        for i in range(len(part)):
            offer(i)
        while queue:
            _, i, piece, j = heapq.heappop(queue)
            if not part[i] or after[i] != j or part[i] + part[j] != piece:
                continue
            if len(piece) == len(text):
                self.halves[text] = part[i], part[j]
            part[i], part[j], after[i] = piece, "", after[j]
            if after[j] < len(part):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in part if p]

    def stays(self, left: str, right: str) -> bool:
        """Whether BPE leaves two of its pieces side by side.

        Their merges are undone, latest first: if, before one of them, the
        parts next to the border formed a piece that merges earlier (or at the
        same score, further left), BPE would have taken that instead.
        """
        cost = lambda p: -self.score[p] if len(p) > 1 else float("-inf")
        limit, strict = float("inf"), True
        while True:
            both = self.score.get(left + right)
            if both is not None and (-both < limit or -both == limit and not strict):
                return False
            a, b = cost(left), cost(right)
            if a == b == float("-inf"):
                return True
            if a > b:
                limit, strict, left = a, True, self.halves[left][1]
            else:
                limit, strict, right = b, False, self.halves[right][0]

    def viterbi(self, text: str) -> list[str]:
        """Pieces (or single characters without a piece) of ``text`` in one pass over its positions."""
        return self._best_scores(text) if self.kind == "unigram" else self._merged(text)

    def _merged(self, text: str) -> list[str]:
        """Runs of characters that some piece covers, and each other character by itself."""
        out: list[str] = []
        at = 0
        while at < len(text):
            stop = at
            while stop < len(text) and text[stop] in self.known:
                stop += 1
            out += [self.pieces[i][0] for i in self._merged_ids(text[at:stop])] if stop > at else [text[at]]
            at = max(stop, at + 1)
        return out

    def _merged_ids(self, text: str) -> list[int]:
        """The one piece that can end each position is the one that stays beside the piece ending where it starts."""
        n, many = len(text), len(self.pieces)
        last, size = [-1] * (n + 1), [0] * (n + 1)
        beside = self.beside
        for end, (piece, length, _) in self.automaton.iter(text):
            end += 1
            if size[end]:
                continue
            left = last[end - length]
            if left >= 0:
                key = left * many + piece
                ok = beside.get(key)
                if ok is None:
                    if len(beside) >= MEMO:
                        beside.clear()
                    ok = beside[key] = self.stays(self.pieces[left][0], self.pieces[piece][0])
                if not ok:
                    continue
            last[end], size[end] = piece, length
        out, at = [], n
        while at:
            out.append(last[at])
            at -= size[at]
        out.reverse()
        return out

    def word_ids(self, text: str) -> list[int]:
        if self.kind == "bpe" and self.known.issuperset(text):
            return self._merged_ids(text)
        return self.ids(self.viterbi(text))

    def _best_scores(self, text: str) -> list[str]:
        n = len(text)
        best, size = [float("-inf")] * (n + 1), [1] * (n + 1)
        best[0] = 0.0
        done = 0
        for end, (_, length, score) in self.automaton.iter(text):
            end += 1
            while done < end - 1:  # positions that no piece ends at take their character as unknown
                done += 1
                if best[done] == float("-inf"):
                    best[done] = best[done - 1] + self.floor
            if best[end - length] + score > best[end]:
                best[end], size[end] = best[end - length] + score, length
        for k in range(done + 1, n + 1):
            if best[k] == float("-inf"):
                best[k] = best[k - 1] + self.floor
        out, at = [], n
        while at:
            out.append(text[at - size[at]:at])
            at -= size[at]
        return out[::-1]

    def ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            i = self.id.get(p)
            if i is not None:
                out.append(i)
            elif self.byte:
                out += [self.byte[b] for b in p.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        text = (MARK if self.prefix else "") + text.replace(" ", MARK)
        if self.words is None:
            return np.array(self.word_ids(text), np.int32)
        return np.frombuffer(b"".join(map(self.memo.__getitem__, self.words.findall(text))), np.int32)

    def decode(self, ids) -> str:
        if not len(ids):
            return ""
        text = b"".join(map(self.out.__getitem__, ids.tolist() if hasattr(ids, "tolist") else ids))
        text = text.decode(errors="replace")
        return text[1:] if self.prefix and text[:1] == " " else text


_codecs: dict[int, Codec] = {}


def _codec(broadcast) -> Codec:
    """The worker's codec of a broadcast model."""
    key = hash(broadcast.value["pieces"])
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(broadcast.value)
    return _codecs[key]


def encode(docs: DataFrame, text: str = "text", model: str = MODEL, ids: str = "token_ids",
           round_trip: str | None = None) -> DataFrame:
    """``docs`` with the array of piece ids; ``round_trip`` names a column telling if they decode to the text."""
    docs = docs.drop(ids, *[round_trip] if round_trip else [])
    shipped = docs.sparkSession.sparkContext.broadcast(load_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped)
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            found = [codec.encode(t) for t in texts]
            offsets = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(x) for x in found], out=offsets[1:])
            values = np.concatenate(found) if found else np.zeros(0, np.int32)
            columns = [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))]
            names = [*batch.schema.names, ids]
            if round_trip:
                columns.append(pa.array([codec.decode(x) == (t or "") for x, t in zip(found, texts, strict=True)], pa.bool_()))
                names.append(round_trip)
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    if round_trip:
        schema = T.StructType([*schema.fields, T.StructField(round_trip, T.BooleanType())])
    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, ids: str = "token_ids", model: str = MODEL, text: str = "decoded") -> DataFrame:
    """``tokens`` with the text that the ids stand for (empty for null or no ids)."""
    tokens = tokens.drop(text)
    shipped = tokens.sparkSession.sparkContext.broadcast(load_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([codec.decode(x or []) for x in lists], pa.string())], [*batch.schema.names, text])

    return tokens.mapInArrow(run, T.StructType([*tokens.schema.fields, T.StructField(text, T.StringType())]))
