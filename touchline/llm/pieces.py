"""SentencePiece encoding and decoding with the pieces and scores of a public model.

A text becomes ``▁`` + text with spaces as ``▁`` (identity normaliser). An Aho-Corasick automaton over all pieces reports, for each
position, the pieces that end there, the longest first and then along its output links; a single pass relaxes the best score at
that position (Viterbi). So the ids are those of the segmentation with the largest sum of scores; of equal sums the
one whose last piece is longest wins, position by position. A character that is no piece itself may also be taken at ``penalty``
below the smallest score, and is written as its UTF-8 bytes. Scores are whole numbers in this model, so sums are exact. A model of
the BPE type is thus read by its scores, not by its merges.

No piece has a space after another character, a line break, or punctuation after a letter, so a text falls apart at these places into
words whose best segmentations are independent; frequent words are searched once and kept in dictionaries of bounded size. A model for which
this does not hold is searched text by text.

Decoding joins the pieces, reads bytes as UTF-8 (broken ones become U+FFFD) and takes off the first space. The round trip is exact for
every text without a literal ``▁``, which reads as a space. A null text encodes to null, an empty text to no id; documents keep
their row, repeated ones too.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from touchline.llm.words import Words, in_chunks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
PENALTY = 10.0
#: Words kept per worker in each of two generations, and the longest of them; some tens of megabytes.
KEPT_WORDS = 200_000
KEPT_LENGTH = 64
#: Crossings after which words would not be independent.
_CROSSING = re.compile(f"[^{SPACE}]{SPACE}|\\n|[A-Za-z\u00c0-\u00ff][!-/:-@\\[-^`{{-~]")
_BYTES = np.arange(256)
_IS_LETTER = np.isin(_BYTES, np.frombuffer(string.ascii_letters.encode(), np.uint8))
_IS_PUNCTUATION = np.isin(_BYTES, np.frombuffer(string.punctuation.replace("_", "").encode(), np.uint8))
_LATIN_LEAD = 0xC3  # of U+00C0 to U+00FF


def independent(data: np.ndarray, offsets: np.ndarray, rows: slice) -> Words:
    """Words with the spaces before them, line breaks alone, and a cut between a letter and punctuation."""
    before = np.zeros(len(data), dtype=np.uint8)
    before[1:] = data[:-1]
    letter = _IS_LETTER[before]
    letter[2:] |= (data[:-2] == _LATIN_LEAD) & (before[2:] >= 0x80)
    begins = (data == 0x20) & (before != 0x20) | (data == 0x0A) | (before == 0x0A) | letter & _IS_PUNCTUATION[data]
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.append(starts[1:], len(data))[: len(starts)], np.searchsorted(starts, offsets), rows, offsets)


def whole(data: np.ndarray, offsets: np.ndarray, rows: slice) -> Words:
    """Each text as one word."""
    full = np.flatnonzero(np.diff(offsets))
    return Words(data, offsets[full], offsets[full + 1], np.searchsorted(full, np.arange(len(offsets))), rows, offsets)


#: Piece types of the model format.
NORMAL, CONTROL, USER_DEFINED, BYTE = 1, 3, 4, 6


class Pieces:
    """Encoder and decoder for one model."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        normal = proto.normalizer_spec
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not proto.trainer_spec.byte_fallback:
            raise ValueError("only models with the identity normaliser and byte fallback are read")
        self.prefix = " " if normal.add_dummy_prefix else ""
        self.automaton = ahocorasick.Automaton()
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        self.singles: set[str] = set()
        lowest, inside = 0.0, False
        for i, piece in enumerate(proto.pieces):
            if piece.type in (NORMAL, USER_DEFINED):
                text = piece.piece
                self.automaton.add_word(text, (len(text), piece.score, i))
                self.bytes_of.append(text.replace(SPACE, " ").encode())
                if len(text) == 1:
                    self.singles.add(text)
                lowest = min(lowest, piece.score)
                inside = inside or _CROSSING.search(text) is not None
            elif piece.type == BYTE:
                self.byte_ids[int(piece.piece[3:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece.piece[3:-1], 16)]))
            else:
                self.bytes_of.append(b"" if piece.type == CONTROL else " ⁇ ".encode())
        self.automaton.make_automaton()
        self.unknown = lowest - PENALTY
        self.cut = whole if inside else independent
        self.is_byte = np.zeros(len(proto.pieces), dtype=bool)
        self.is_byte[self.byte_ids] = True
        self.known: dict[bytes, np.ndarray] = {}
        self.older: dict[bytes, np.ndarray] = {}

    def best(self, word: str) -> list[int]:
        """Ids of the best segmentation; ``word`` holds spaces as spaces."""
        word = word.replace(" ", SPACE)
        size = len(word)
        score = [float("-inf")] * (size + 1)
        score[0] = 0.0
        back: list = [None] * (size + 1)
        if self.singles.issuperset(word):
            lone = []
        else:
            lone = [i for i, c in enumerate(word) if c not in self.singles]
        at = 0
        for last, found in self.automaton.iter(word):
            end = last + 1
            while at < len(lone) and lone[at] < end:
                self._relax_lone(score, back, lone[at])
                at += 1
            reached = score[end - found[0]] + found[1]
            if reached > score[end]:
                score[end] = reached
                back[end] = found
        for i in lone[at:]:
            self._relax_lone(score, back, i)
        ids: list[int] = []
        end = size
        while end:
            length, _, piece = back[end]
            if piece < 0:
                ids.extend(self.byte_ids[b] for b in reversed(word[end - 1].encode()))
            else:
                ids.append(piece)
            end -= length
        ids.reverse()
        return ids

    def _relax_lone(self, score: list, back: list, i: int) -> None:
        reached = score[i] + self.unknown
        if reached > score[i + 1]:
            score[i + 1] = reached
            back[i + 1] = (1, self.unknown, -1)

    def _searched(self, word: bytes) -> np.ndarray:
        """Ids of a word that is not in the younger generation."""
        found = self.older.get(word)
        if found is None:
            found = np.array(self.best(word.decode()), dtype=np.int32)
        if len(word) <= KEPT_LENGTH:
            if len(self.known) >= KEPT_WORDS:
                self.older, self.known = self.known, {}
            self.known[word] = found
        return found

    def encode_array(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text. Each distinct word of some megabytes is looked up once, then all places are filled."""
        filled = pc.replace_substring(texts, SPACE, " ")
        filled = pc.if_else(pc.greater(pc.binary_length(filled), 0), pc.binary_join_element_wise(self.prefix, filled, ""), filled)
        parts = []
        for words in in_chunks(filled, self.cut):
            sizes = np.zeros(len(words.starts) + 1, dtype=np.int64)
            ids = np.empty(0, dtype=np.int32)
            if len(words.starts):
                sample, which = words.distinct()
                data = words.data.tobytes()
                found = []
                for start, end in zip(words.starts[sample].tolist(), words.ends[sample].tolist(), strict=True):
                    word = data[start:end]
                    hit = self.known.get(word)
                    found.append(self._searched(word) if hit is None else hit)
                length = np.array([len(f) for f in found])
                begin = np.cumsum(length) - length
                np.cumsum(length[which], out=sizes[1:])
                shift = np.repeat(begin[which] - sizes[:-1], length[which])
                ids = np.concatenate(found)[shift + np.arange(sizes[-1])]
            parts.append(pa.ListArray.from_arrays(pa.array(sizes[words.first], pa.int32()), pa.array(ids)))
        made = pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))
        return pc.if_else(texts.is_valid(), made, pa.scalar(None, made.type)) if texts.null_count else made

    def encode(self, text: str) -> list[int]:
        return self.encode_array(pa.array([text], pa.string()))[0].as_py()

    def decode(self, ids) -> str:
        table = self.bytes_of
        text = b"".join([table[i] for i in ids]).decode("utf-8", "replace")
        return text[len(self.prefix) :] if text.startswith(self.prefix) else text


_loaded: dict[bytes, Pieces] = {}


def loaded(model: bytes) -> Pieces:
    """The encoder of this worker; it is built once and used by all its tasks."""
    key = hashlib.sha256(model).digest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Pieces(model)
    return _loaded[key]


def read_model(path: str) -> bytes:
    """The model file, read on the driver; half a megabyte travels with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def decode_array(pieces: Pieces, ids: pa.Array) -> pa.Array:
    return pa.array([None if (row := v.values) is None else pieces.decode(row.to_pylist()) for v in ids], pa.string())


def _mapped(df: DataFrame, column: str, target: str, kind: str, convert, path: str) -> DataFrame:
    """``df`` with one more column made from another, batch by batch."""
    model = read_model(path)
    others = [c for c in df.columns if c != target]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                made = convert(pieces, part.column(column))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), made], [*others, target])

    fields = ", ".join(f"`{c}` {t}" for c, t in df.select(*others).dtypes)
    return df.select(*others).mapInArrow(task, f"{fields}, `{target}` {kind}")


def encoded(docs: DataFrame, path: str = MODEL, text: str = "text", target: str = "token_ids") -> DataFrame:
    """All columns of ``docs`` and the ids of each text; a column of the target's name is replaced."""
    return _mapped(docs, text, target, "array<int>", Pieces.encode_array, path)


def decoded(tokens: DataFrame, path: str = MODEL, ids: str = "token_ids", target: str = "decoded") -> DataFrame:
    """All columns and the text of each row's ids."""
    return _mapped(tokens, ids, target, "string", decode_array, path)


def round_trips(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``doc_id, n_tokens, n_byte_tokens, ids_sha256, round_trip``: both ways in one task, the ids as a digest of little-endian 32-bit.

    A null text counts as empty here.
    """
    model = read_model(path)
    names = ["doc_id", "n_tokens", "n_byte_tokens", "ids_sha256", "round_trip"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model)
        for batch in batches:
            rows = []
            texts = pc.fill_null(batch.column("text"), "")
            for low in range(0, len(texts), 256):
                part = texts.slice(low, 256)
                for value, row in zip(part, pieces.encode_array(part), strict=True):
                    ids = row.values.to_numpy().astype("<i4", copy=False)
                    same = pieces.decode(ids.tolist()) == value.as_py().replace(SPACE, " ")
                    rows.append((len(ids), int(pieces.is_byte[ids].sum()), hashlib.sha256(ids.tobytes()).hexdigest(), same))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
            made = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names)

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, n_tokens long, n_byte_tokens long, ids_sha256 string, round_trip boolean")
