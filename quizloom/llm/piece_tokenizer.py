"""SentencePiece encoding and decoding with an Aho-Corasick automaton over the pieces.

The automaton reads a text once. At each position its output links give every piece
that ends there, and the pass keeps the best last piece of the text so far:

- ``unigram`` models, and any model on request (``by_score``): the piece with the best sum of
  scores (Viterbi);
- ``bpe`` models, whose scores are the order of merges: the one piece that the merges
  leave at the end of the text so far. Of the pieces that end at a position exactly one
  keeps its border with the piece before it, and a border is decided by the two pieces
  beside it. A sum of merge orders means nothing to such a model: its best sum is
  another segmentation than the library's.

No piece has a blank after another character, so blanks cut a text into units whose
pieces don't depend on each other; each distinct unit is worked out once.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizloom.llm.common import MB, pieces, run_sums

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Words whose pieces a worker remembers; of their parts and of the pairs of pieces, twice as many.
REMEMBERED = 300_000
#: Longer words and parts, in characters, aren't remembered.
LONGEST = 64
BLANK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, BYTE = 1, 6
ENCODER = "_encoder"


class Model:
    """What of a ``.model`` file the passes need, as plain values."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rules = proto.normalizer_spec
        if proto.trainer_spec.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and bpe models are read")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
            raise ValueError("only models that take texts as they are, after one blank, are read")
        if not proto.trainer_spec.byte_fallback:
            raise ValueError("a model without byte pieces can't give every text back")
        self.kind = proto.trainer_spec.model_type
        self.texts = [p.piece for p in proto.pieces]
        self.scores = [p.score for p in proto.pieces]
        self.normal = [i for i, p in enumerate(proto.pieces) if p.type == NORMAL]
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        if any(BLANK in self.texts[i].lstrip(BLANK) for i in self.normal):
            raise ValueError("pieces with a blank after another character are not read")
        self.halves = merge_halves(self) if self.kind == BPE else {}

    @classmethod
    def of(cls, values: dict) -> Model:
        """A model from the plain values of another: workers that get a broadcast may not have this module."""
        model = cls.__new__(cls)
        model.__dict__.update(values)
        return model


def encoder_of(values: dict) -> Encoder:
    """One encoder for all tasks of a worker, kept beside the values: what one task works out, the next one finds."""
    if ENCODER not in values:
        values[ENCODER] = Encoder(Model.of(values))
    return values[ENCODER]


def merge_order(model: Model) -> dict[str, int]:
    """When a piece is merged: the best score first, equal scores together."""
    ranks = {s: r for r, s in enumerate(sorted({model.scores[i] for i in model.normal}, reverse=True))}
    return {model.texts[i]: ranks[model.scores[i]] for i in model.normal}


def merges(symbols: list[str], order: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """What is left when no neighbours can merge, and the last two merged."""
    last = None
    while True:
        found = [(order[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in order]
        if not found:
            return symbols, last
        _, i = min(found)
        last = symbols[i], symbols[i + 1]
        symbols = [*symbols[:i], "".join(last), *symbols[i + 2 :]]


def merge_halves(model: Model) -> dict[str, tuple[str, str] | None]:
    """The two halves that each piece is merged from, None for single characters; others never occur."""
    order = merge_order(model)
    halves: dict[str, tuple[str, str] | None] = {}
    for piece in order:
        left, last = merges(list(piece), order)
        if left == [piece]:
            halves[piece] = last
    return halves


class Encoder(dict):
    """Words to the ids of their pieces, as the bytes of ``int32`` values.

    A key is what follows one blank; if it starts with a line end, it has no blank before it.
    """

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.ids = {model.texts[i]: i for i in model.normal}
        self.order = merge_order(model)
        self.borders: dict[tuple[str, str], bool] = {}
        used = model.halves if model.kind == BPE else self.ids
        self.automaton = ahocorasick.Automaton()
        for piece in used:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        known = "".join(sorted({c for piece in used for c in piece}))
        self.known = re.compile(f"([{re.escape(known)}]+)")
        self.parts: dict[str, bytes] = {}
        self.decoder = Decoder(model)
        self.apart = all(PARTS.fullmatch(piece) for piece in used)
        self.lines = "\n" not in known

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        text = word if word[:1] == "\n" else BLANK + word
        if len(self.borders) >= 2 * REMEMBERED:
            self.borders.clear()
        found = [self.part(x) for x in PARTS.findall(text)] if self.apart else [self.part_of(text)]
        joined = b"".join(found)
        if len(word) <= LONGEST:
            self[word] = joined
        return joined

    def part_of(self, text: str) -> bytes:
        return array("i", self.unit(text)).tobytes()

    def part(self, text: str) -> bytes:
        """``part_of`` with a memory of its own: words share parts."""
        ids = self.parts.get(text)
        if ids is None:
            if len(self.parts) >= 2 * REMEMBERED:
                self.parts.clear()
            ids = self.part_of(text)
            if len(text) <= LONGEST:
                self.parts[text] = ids
        return ids

    def comes_back(self, text: str, ids: bytes) -> bool:
        """Whether decoding the ids of ``text`` gives it."""
        return self.decoder.decode(np.frombuffer(ids, np.int32).tolist()) == text

    def unit(self, text: str) -> list[int]:
        """Characters that are in no piece become byte pieces; nothing spans them."""
        if self.known.fullmatch(text):
            return [self.ids[p] for p in self.best(text)]
        ids = []
        for i, part in enumerate(self.known.split(text)):
            if i % 2:
                ids += [self.ids[p] for p in self.best(part)]
            else:
                ids += [self.model.bytes[b] for b in part.encode()]
        return ids

    def best(self, text: str) -> list[str]:
        """One pass over ``text``: the best piece to end at each position."""
        last: list[str | None] = [None] * (len(text) + 1)
        if self.model.kind == BPE:
            borders = self.borders
            for end, piece in self.automaton.iter(text):
                if last[end + 1] is None:
                    before = end + 1 - len(piece)
                    if before:
                        pair = last[before], piece
                        holds = borders.get(pair)
                        if holds is None:
                            holds = borders[pair] = pair[0] is not None and self.holds(*pair)
                        if not holds:
                            continue
                    last[end + 1] = piece
            if last[-1] is None:
                return merges(list(text), self.order)[0]
        else:
            scores = self.model.scores
            total = [0.0] + [float("-inf")] * len(text)
            for end, piece in self.automaton.iter(text):
                score = total[end + 1 - len(piece)] + scores[self.ids[piece]]
                if score > total[end + 1]:
                    total[end + 1], last[end + 1] = score, piece
        path, at = [], len(text)
        while at:
            path.append(last[at])
            at -= len(last[at])
        return path[::-1]

    def holds(self, left: str, right: str) -> bool:
        """Whether merges leave the border between two pieces.

        The two are taken apart again, the later merge first. The border is lost if what
        meets there could merge before the merge that was just undone; of equal merges
        the one more to the left comes first.
        """
        order, halves, limit = self.order, self.model.halves, len(self.order) + 1
        while True:
            if order.get(left + right, limit) < limit:
                return False
            parts_left, parts_right = halves[left], halves[right]
            if parts_left and (not parts_right or order[left] > order[right]):
                limit, left = order[left], parts_left[1]
            elif parts_right:
                limit, right = order[right] + 1, parts_right[0]
            else:
                return True

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, as the bytes of ``int32`` values."""
        if not text:
            return b""
        found: list[bytes] = []
        for i, line in enumerate(text.split("\n") if self.lines else [text]):
            words = line.split(" ")
            if "" in words or BLANK in line:
                marked = ("\n" if i else BLANK) + line.replace(" ", BLANK)
                words = [u.removeprefix(BLANK) for u in UNITS.findall(marked)]
            elif i:
                words[0] = "\n" + words[0]
            found.extend(map(self.__getitem__, words))
        return b"".join(found)


UNITS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
#: Letters, or others, each with the blanks before them.
PARTS = re.compile(rf"{BLANK}*[^\W\d_]+|{BLANK}*(?:(?!{BLANK})[\W\d_])+|{BLANK}+")


class Decoder:
    """Ids to text."""

    def __init__(self, model: Model):
        self.parts = [t.replace(BLANK, " ").encode() for t in model.texts]
        for value, i in model.bytes.items():
            self.parts[i] = bytes([value])

    def raw(self, ids: list[int]) -> bytes:
        return b"".join(map(self.parts.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.raw(ids).removeprefix(b" ").decode("utf-8", "replace")


def encode_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, by_score: bool = False
) -> DataFrame:
    """``key``, ``ids`` (array of int), ``n_tokens`` and ``round_trip`` of each row's whole text.

    With ``by_score`` a ``bpe`` model's pieces are chosen by the best sum of their scores too, as
    those of ``unigram`` models are: not its library's segmentation, but one that decodes alike.
    ``score`` is that sum then; byte pieces add nothing.
    ``round_trip`` tells whether decoding gives the text back. It does, but for texts that
    hold the blank mark U+2581 itself, which decodes to a blank. A null or empty text has
    no ids. Null keys and repeated rows are encoded like others, an empty table gives an
    empty table, and columns other than ``key`` and ``text`` are not read.
    """
    values = vars(Model(vocabulary))
    if by_score:
        values = values | {"kind": UNIGRAM}
    model = docs.sparkSession.sparkContext.broadcast(values)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What a worker remembers has no cycles, and looking for some takes a sixth of the time.
        gc.disable()
        try:
            yield from encoded(batches)
        finally:
            gc.enable()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model.value)
        for part, texts in pieces(batches, "text", 2 * MB):
            texts = [t.decode() for t in texts]
            ids = [encoder.encode(t) for t in texts]
            sizes = np.array([len(x) // 4 for x in ids], np.int64)
            values = np.frombuffer(b"".join(ids), np.int32)
            same = [encoder.comes_back(t, x) for x, t in zip(ids, texts)]
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            columns = [
                part.column("key"),
                pa.ListArray.from_arrays(offsets, pa.array(values)),
                pa.array(sizes),
                pa.array(same),
            ]
            if by_score:
                columns.append(pa.array(run_sums(np.array(encoder.model.scores)[values], sizes)))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    schema = T.StructType(
        [
            T.StructField(key, rows.schema["key"].dataType),
            *T.StructType.fromDDL("ids array<int>, n_tokens long, round_trip boolean").fields,
            *([T.StructField("score", T.DoubleType())] if by_score else []),
        ]
    )
    return rows.mapInArrow(encode, schema)


def decode_ids(
    encoded: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str = VOCABULARY
) -> DataFrame:
    """``key`` and the ``text`` of each row's ids; null ids give a null text, no ids an empty one."""
    model = encoded.sparkSession.sparkContext.broadcast(vars(Model(vocabulary)))
    rows = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Model.of(model.value))
        for batch in batches:
            texts = [None if x is None else decoder.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], [key, "text"])

    schema = T.StructType(
        [T.StructField(key, rows.schema["key"].dataType), T.StructField("text", T.StringType())]
    )
    return rows.mapInArrow(decode, schema)
