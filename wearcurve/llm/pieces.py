"""SentencePiece encoding and decoding of merge-type (BPE) models, by backtracking.

The model file is read once on the driver; its vocabulary goes to the tasks (bounded by the model). A text is
cut before each run of spaces (no piece spans such a place, which is checked on loading), and the ids of a word
are found once per worker:

- an Aho-Corasick automaton gives the longest piece that starts at a position, and each piece knows the longest
  piece that is a proper prefix of it;
- the longest piece that fits the piece before it is taken. Two neighbours fit if merging the characters of both
  from scratch gives these two again; answers are kept by pair;
- a bitfield marks positions from which the word cannot be completed, so that none is tried twice.

A sequence whose neighbours all fit is the library's result: the first merge across a border would also happen
in the pair alone. Hence each position is reached by one sequence only, and the bitfield is exact.

Characters outside the vocabulary become byte pieces and separate what is around them. Null and empty texts have
no ids but the end id. Decoding skips control ids and nulls; a null list decodes to the empty text; ids outside
the vocabulary fail the job. Other columns pass through untouched.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from wearcurve.llm.batches import small_batches
from wearcurve.llm.memo import Memo, held

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


@dataclass(frozen=True)
class PieceModel:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    end_id: int

    @property
    def key(self) -> str:
        return sha256(repr((self.pieces, self.scores)).encode()).hexdigest()


def load_model(path: str) -> PieceModel:
    """Read a model file on the driver; fail if it is of a kind that this encoder does not cover."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm, trainer = proto.normalizer_spec, proto.trainer_spec
    model = PieceModel(
        tuple(p.piece for p in proto.pieces),
        tuple(p.score for p in proto.pieces),
        tuple(p.type for p in proto.pieces),
        next((i for i, p in enumerate(proto.pieces) if p.piece == trainer.eos_piece and p.type == CONTROL), -1),
    )
    plain = [p for p, k in zip(model.pieces, model.kinds, strict=True) if k == NORMAL]
    letters = {p for p in plain if len(p) == 1}
    if not (
        trainer.model_type == trainer.BPE
        and trainer.byte_fallback
        and not trainer.treat_whitespace_as_suffix
        and norm.add_dummy_prefix
        and norm.escape_whitespaces
        and not norm.remove_extra_whitespaces
        and not norm.precompiled_charsmap
        and set(model.kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}
        and all(letters.issuperset(p) and not re.search(f"[^{SPACE}]{SPACE}", p) for p in plain)
    ):
        raise ValueError(f"{path}: only merge-type models with byte fallback and no text normalisation are supported")
    return model


class Encoder:
    """Encodes texts to ids; one per Python worker."""

    def __init__(self, model: PieceModel):
        import ahocorasick

        self.model = model
        self.normal = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == NORMAL}
        self.letters = {p for p in self.normal if len(p) == 1}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(model.pieces) if model.kinds[i] == BYTE}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.normal.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.sizes = [len(p) for p in model.pieces]
        self.most = max(map(len, self.normal))
        self.shorter = [-1] * len(model.pieces)  # the longest piece that is a proper prefix of a piece
        for piece, i in self.normal.items():
            self.shorter[i] = next((self.normal[piece[:k]] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.normal), -1)
        self.fits = Memo(self._fits, 150_000)  # by first id x number of pieces + second id
        self.alone = Memo(lambda i: self.merged(model.pieces[i]) == [i])
        self.words = Memo(lambda word: self._ids(SPACE + word), 200_000)  # of a word with the space before it
        self.parts = Memo(self._ids, 50_000)  # of a part of a word

    def merged(self, text: str) -> list[int]:
        """Ids of a short text of known characters, by plain merging: best score first, then leftmost."""
        symbols, scores, normal = list(text), self.model.scores, self.normal
        while len(symbols) > 1:
            best = None
            for k in range(len(symbols) - 1):
                i = normal.get(symbols[k] + symbols[k + 1])
                if i is not None and (best is None or scores[i] > best[0]):
                    best = (scores[i], k)
            if best is None:
                break
            k = best[1]
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        return [normal[s] for s in symbols]

    def _fits(self, pair: int) -> bool:
        pieces = self.model.pieces
        first, second = divmod(pair, len(pieces))
        return self.merged(pieces[first] + pieces[second]) == [first, second]

    def longest(self, text: str, at: int) -> int:
        """Id of the longest piece that starts at a position; a single character is always one."""
        size = self.automaton.longest_prefix(text[at : at + self.most])
        normal = self.normal
        while (found := normal.get(text[at : at + size])) is None:
            size -= 1
        return found

    def search(self, text: str) -> list[int]:
        """Ids of a text of known characters, by backtracking."""
        n, sizes, fits, shorter, many = len(text), self.sizes, self.fits, self.shorter, len(self.model.pieces)
        failed = bytearray(n // 8 + 1)
        path: list[int] = []
        at, piece = 0, self.longest(text, 0)
        while True:
            if piece < 0:  # nothing fits here: give up this position and shorten the piece before it
                failed[at >> 3] |= 1 << (at & 7)
                piece = path.pop()
                at -= sizes[piece]
                piece = shorter[piece]
                continue
            end = at + sizes[piece]
            if not failed[end >> 3] >> (end & 7) & 1 and (fits[path[-1] * many + piece] if path else self.alone[piece]):
                path.append(piece)
                if end == n:
                    return path
                at, piece = end, self.longest(text, end)
            else:
                piece = shorter[piece]

    def _ids(self, text: str) -> bytes:
        if self.letters.issuperset(text):
            return _packed(self.search(text))
        out, known = [], ""
        for c in [*text, None]:
            if c in self.letters:
                known += c
                continue
            if known:
                out.append(self.words[known[1:]] if known[0] == SPACE else self.parts[known])
                known = ""
            if c is not None:
                out.append(_packed([self.bytes[b] for b in c.encode("utf-8")]))
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a whole text, without an end id."""
        if not text:
            return b""
        text = text.replace(SPACE, " ")
        if "  " in text or text[0] == " ":
            words = [w[1:] for w in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))]
        else:
            words = text.split(" ")
        return b"".join(map(self.words.__getitem__, words))


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class Decoder:
    """Turns ids back into text; one per Python worker."""

    def __init__(self, model: PieceModel):
        self.table = [
            b"" if k == CONTROL
            else bytes([int(p[3:5], 16)]) if k == BYTE
            else " ⁇ ".encode() if k == UNKNOWN
            else p.replace(SPACE, " ").encode()
            for p, k in zip(model.pieces, model.kinds, strict=True)
        ]
        self.normal = [k == NORMAL for k in model.kinds]
        self.control = {i for i, k in enumerate(model.kinds) if k == CONTROL}
        self.single = {i for i, k in enumerate(model.kinds) if k == BYTE}

    def decode(self, ids: list[int | None] | None) -> str:
        if not ids:
            return ""
        ids = [i for i in ids if i is not None]
        first = next((i for i in ids if self.table[i]), None)
        cut = int(first is not None and self.normal[first] and self.table[first][:1] == b" ")
        if self.control.isdisjoint(ids[:-1]):
            try:
                return b"".join(map(self.table.__getitem__, ids))[cut:].decode("utf-8")
            except UnicodeDecodeError:
                pass
        out, run = [], b""  # byte pieces that follow each other are read together
        for i in [*ids, None]:
            if i is not None and i in self.single:
                run += self.table[i]
                continue
            out.append(_decoded(run))
            run = b""
            out.append("" if i is None else self.table[i].decode("utf-8"))
        return "".join(out)[cut:]


def _decoded(raw: bytes) -> str:
    """Decode with one replacement character for each byte that starts no valid character."""
    out = ""
    while raw:
        try:
            return out + raw.decode("utf-8")
        except UnicodeDecodeError as e:
            out += raw[: e.start].decode("utf-8") + "\ufffd"
            raw = raw[e.start + 1 :]
    return out


def _lists(packed: list[bytes]) -> pa.ListArray:
    """Packed ids as lists."""
    import numpy as np

    offsets = np.zeros(len(packed) + 1, dtype=np.int32)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32)))


def encode(text: Column | str, model: PieceModel, end: bool = True) -> Column:
    """Ids of whole texts as ``array<int>``, equal to the library's ``encode(text, add_eos=end)``."""
    key = model.key
    tail = _packed([model.end_id]) if end else b""

    small_batches()

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        encoder = held("enc" + key, lambda: Encoder(model))
        return _lists([encoder.encode(t) + tail for t in texts.to_pylist()])

    # else the optimizer may put the call into every expression that reads the ids
    return ids.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def round_trip(text: Column | str, model: PieceModel, end: bool = True) -> Column:
    """Struct (ids, same): what ``encode`` gives, and whether ``decode`` gives the text back, with its pieces' space as a space.

    Both in one call: two calls in a row keep twice as many Python workers, each with a vocabulary and its memos.
    """
    key = model.key
    tail = _packed([model.end_id]) if end else b""
    small_batches()

    @F.arrow_udf("struct<ids array<int>, same boolean>")
    def both(texts: pa.Array) -> pa.Array:
        encoder, decoder = held("enc" + key, lambda: Encoder(model)), held("dec" + key, lambda: Decoder(model))
        known = [t or "" for t in texts.to_pylist()]
        packed = [encoder.encode(t) + tail for t in known]
        same = [decoder.decode(array("i", p).tolist()) == t.replace(SPACE, " ") for t, p in zip(known, packed, strict=True)]
        return pa.StructArray.from_arrays([_lists(packed), pa.array(same, pa.bool_())], ["ids", "same"])

    return both.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def _plain(ids: pa.Array | None) -> list[int | None]:
    if ids is None:
        return []
    return ids.to_pylist() if ids.null_count else ids.to_numpy().tolist()


def decode(ids: Column | str, model: PieceModel) -> Column:
    """Texts of id lists, equal to the library's ``decode(ids)``."""
    key = model.key
    small_batches()

    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        decoder = held("dec" + key, lambda: Decoder(model))
        return pa.array([decoder.decode(_plain(x.values)) for x in lists], pa.string())

    return texts(F.col(ids) if isinstance(ids, str) else ids)
