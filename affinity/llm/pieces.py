"""SentencePiece encoding with byte spans in the source text, and decoding.

Ids come from the sentencepiece library; what it normalises inside is done here a second time
with the alignment kept: at each place the longest entry of the model's compiled character map
that the text starts with is replaced by its normal form (one character stands for itself where
there is none), white space is escaped, and every normalised byte remembers the source byte it
came from. The bytes of the pieces, laid end to end, are the normalised text, so each piece maps
back to a span of source bytes; the spans tile the text. A model without a character map, as
``piece_bpe_32k``, is aligned with array operations.

The model is read where the job is planned and sent with the tasks (its size does not depend on
the data). Defined cases: a null or empty text has no ids and decodes to an empty text; repeated
rows are encoded each; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from affinity.llm.whole_rows import map_whole_rows
from affinity.llm.words import slices

ESCAPED = "▁".encode()
_REPLACEMENT = "�".encode()


class CharacterMap:
    """The compiled map of a model: a double-array trie of source strings and their forms.

    Fixed format: the trie's size in bytes, its 32-bit units, the forms ended by zero bytes. A
    unit holds a label in its low byte (and bit 31), a leaf flag in bit 8, an offset from bit 10,
    shifted by 8 more if bit 9 is set; a leaf's value is the place of the form.
    """

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.forms = blob[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and normal form of the longest entry that ``text[at:]`` starts with."""
        if not self.units:
            return None
        unit, found = self.units[0], None
        node = (unit >> 10) << ((unit & 512) >> 6)
        for place in range(at, len(text)):
            node ^= text[place]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != text[place]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = place + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.forms[found[1]:self.forms.index(0, found[1])]


@dataclass
class PieceModel:
    """A sentencepiece model from its file's bytes, with its normalisation and piece lengths."""

    proto: bytes
    processor: sentencepiece.SentencePieceProcessor = field(init=False)

    def __post_init__(self) -> None:
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=self.proto)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.proto)
        spec, kinds = model.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.escape = spec.add_dummy_prefix, spec.escape_whitespaces
        self.trim = spec.remove_extra_whitespaces
        self.space = ESCAPED if self.escape else b" "
        if model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with white space as suffix are not supported")
        #: Bytes of each piece; one for a byte piece, none known for the unknown piece.
        self.lengths = np.array([1 if p.type == kinds.BYTE else -1 if p.type == kinds.UNKNOWN
                                 else len(p.piece.encode()) for p in model.pieces])
        self.names = [str(i) for i in range(len(model.pieces))]

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normal form and, for each of its bytes and its end, the source byte."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if not self.map.units and not self.trim:
            data = np.frombuffer(text, np.uint8)
            widths = np.where(data == 32, len(self.space), 1)
            lead = self.space if self.prefix else b""
            source = np.concatenate([np.zeros(len(lead), np.int64),
                                     np.repeat(np.arange(len(data)), widths), [len(data)]])
            return lead + text.replace(b" ", self.space), source
        return self._by_map(text)

    def _by_map(self, text: bytes) -> tuple[bytes, np.ndarray]:
        out, source, at = bytearray(), [], 0
        after_space = self.trim
        if self.prefix:
            out += self.space
            source += [0] * len(self.space)
        lead = len(out)
        while at < len(text):
            found = self.map.longest(text, at)
            if found is None:
                width = 1 if text[at] < 0x80 else 2 if text[at] < 0xE0 else 3 if text[at] < 0xF0 else 4
                form = text[at:at + width]
                try:
                    form.decode()
                except UnicodeDecodeError:
                    width, form = 1, _REPLACEMENT
            else:
                width, form = found
            for byte in form:
                if byte == 32 and self.trim and after_space:
                    continue
                piece = self.space if byte == 32 else bytes([byte])
                out += piece
                source += [at] * len(piece)
                after_space = byte == 32
            at += width
        end = at
        while self.trim and len(out) > lead and out.endswith(self.space):
            del out[-len(self.space):]
            end = source[-len(self.space)]
            del source[-len(self.space):]
        if self.trim and len(out) == lead:
            return b"", np.array([end])
        if self.trim and self.prefix and len(source) > lead:  # leading space belongs to no piece
            source[:lead] = [source[lead]] * lead
        return bytes(out), np.array([*source, end])

    def spans(self, text: bytes, ids: np.ndarray) -> np.ndarray:
        """Source bytes where the pieces begin, and the end of the last one."""
        form, source = self.normalise(text)
        sizes = self.lengths[ids]
        if (sizes < 0).any():
            shown = self.processor.encode(text.decode(), out_type=str)
            sizes = np.array([n if n >= 0 else len(s.encode()) for n, s in zip(sizes, shown, strict=True)])
        ends = np.cumsum(sizes)
        if (int(ends[-1]) if len(ends) else 0) != len(form):
            raise ValueError("the pieces are not the normalised text")
        return source[np.concatenate([[0], ends]).astype(np.int64)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids) if ids else ""


def load(path: str) -> bytes:
    """The bytes of a model file of the machine that plans the job."""
    with open(path, "rb") as file:
        return file.read()


def _encoded(proto: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Per slice: its rows, model, texts, and the ids and spans of each text."""
    model = PieceModel(proto)
    for batch in batches:
        for part in slices(batch.column("text")):
            raw = part.data.tobytes()
            texts = [raw[a:b] for a, b in zip(part.offsets[:-1], part.offsets[1:], strict=True)]
            ids = model.encode([t.decode() for t in texts])
            spans = [model.spans(t, np.array(i, dtype=np.int64)) for t, i in zip(texts, ids, strict=True)]
            yield batch.slice(part.start, part.n_rows), model, texts, ids, spans


def encode(documents: DataFrame, proto: bytes) -> DataFrame:
    """``doc_id, ids, begins, ends``: piece ids of the whole text and their source byte spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ints = pa.list_(pa.int32())
        for rows, _, _, ids, spans in _encoded(proto, batches):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(ids, ints), pa.array([s[:-1].astype(np.int32) for s in spans], ints),
                 pa.array([s[1:].astype(np.int32) for s in spans], ints)], ["doc_id", "ids", "begins", "ends"])

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, ids array<int>, begins array<int>, ends array<int>")


def decode(encoded: DataFrame, proto: bytes) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids decode to an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(proto)
        for batch in batches:
            texts = [model.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(documents: DataFrame, proto: bytes) -> DataFrame:
    """Digests of encoding and decoding each whole text.

    ``doc_id, n_tokens, ids_sha256, decoded_sha256, n_spanned_bytes``: the number of ids, the
    SHA-256 of the decimal ids joined by commas and of the decoded text, and the source bytes
    that the spans of the pieces cover together.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, model, _, ids, spans in _encoded(proto, batches):
            names = model.names
            listed = [hashlib.sha256(",".join([names[i] for i in one]).encode()).hexdigest() for one in ids]
            decoded = [hashlib.sha256(model.decode(one).encode()).hexdigest() for one in ids]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([len(one) for one in ids], pa.int64()), pa.array(listed, pa.string()),
                 pa.array(decoded, pa.string()),
                 pa.array([int(s[-1] - s[0]) for s in spans], pa.int64())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_spanned_bytes"])

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_spanned_bytes long")


_ADDED = T.StructType([T.StructField("piece_ids", T.ArrayType(T.IntegerType())),
                       T.StructField("decoded", T.StringType())])


def _rows_with_ids(proto: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, model, texts, ids, spans in _encoded(proto, batches):
        for text, span in zip(texts, spans, strict=True):
            if not model.trim and (int(span[0]), int(span[-1])) != (0, len(text)):
                raise ValueError("the spans of the pieces do not tile the text")
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(ids, pa.list_(pa.int32())),
             pa.array([model.decode(one) for one in ids], pa.string())],
            [*rows.schema.names, *_ADDED.names])


def with_ids(documents: DataFrame, proto: bytes) -> DataFrame:
    """All columns of ``documents`` and ``piece_ids array<int>``, ``decoded string`` of their texts.

    Columns of these two names in ``documents`` are replaced. The pieces are aligned with the source as
    in ``encode``; a text that they do not tile is an error.
    """
    return map_whole_rows(documents.drop(*_ADDED.names), partial(_rows_with_ids, proto), _ADDED)
