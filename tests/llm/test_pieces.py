"""Ids and texts as the library gives them, alignment as it aligns, spans that tile the text."""

import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from affinity.llm import pieces
from affinity.llm.pieces import CharacterMap, PieceModel, decode, encode, load, round_trip, with_ids

PATH = public_tokenizers.path("piece_bpe_32k.model")
PROTO = load(PATH)
MODEL = PieceModel(PROTO)
TEXTS = ["", "a", "Hello  world \n x", " lead", "trail ", "▁ under ▁▁", "\t\r\n", "naïve ﬁ ２ 😀 \u0000 é",
         "x" * 3000, "many words " * 2000, None]


@given(st.text(max_size=80))
@settings(max_examples=200, deadline=None)
def test_spans_tile_any_text(text):
    raw, ids = text.encode("utf-8", "replace"), MODEL.processor.encode(text.encode("utf-8", "replace").decode())
    spans = MODEL.spans(raw, np.array(ids, dtype=np.int64))
    assert (np.diff(spans) >= 0).all() and spans[0] == 0 and spans[-1] == len(raw)


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
def test_character_map_against_the_library(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    model = PieceModel.__new__(PieceModel)
    model.map = CharacterMap(proto.normalizer_spec.precompiled_charsmap)
    spec = proto.normalizer_spec
    model.prefix, model.trim = spec.add_dummy_prefix, spec.remove_extra_whitespaces
    model.space = "▁".encode() if spec.escape_whitespaces else b" "
    for text in ["ﬁne ２４ Ünïcode", "ｶﾞ㍿", "Straße  ª½", "é  x​", "plain", "  a   b  ", "   "]:
        wanted, places = library.normalize(text, with_offsets=True)
        form, source = model._by_map(text.encode())
        starts = [len(text.encode()[:b].decode()) for b in source[:-1]]
        by_character, at = [], 0
        for character in form.decode():
            by_character.append(starts[at])
            at += len(character.encode())
        assert form.decode() == wanted
        assert by_character == list(places)[:len(by_character)]


def test_round_trip_equals_the_library(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for row in round_trip(docs, PROTO).collect():
        text = TEXTS[row.doc_id] or ""
        ids = library.encode(text)
        assert row.n_tokens == len(ids) and row.n_spanned_bytes == len(text.encode())
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_spans_hold_the_pieces(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    encoded = encode(docs, PROTO)
    for row in encoded.collect():
        raw = (TEXTS[row.doc_id] or "").encode()
        shown = MODEL.processor.encode(raw.decode(), out_type=str)
        for piece, a, b in zip(shown, row.begins, row.ends, strict=True):
            if not piece.startswith("<0x") and "▁" not in raw.decode():
                assert raw[a:b].decode() in (piece.replace("▁", " "), piece.removeprefix("▁").replace("▁", " "))
    back = {r.doc_id: r.text for r in decode(encoded, PROTO).collect()}
    assert all(back[i] == MODEL.decode(MODEL.processor.encode(t or "")) for i, t in enumerate(TEXTS))


def test_empty_repeated_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert round_trip(docs, PROTO).count() == 0
    docs = spark.createDataFrame([(1, "a b", 5, "x"), (1, "a b", 6, "y"), (None, None, 7, "z")],
                                 "doc_id long, text string, ids int, decoded string")
    assert round_trip(docs, PROTO).count() == 3
    out = with_ids(docs, PROTO)
    assert out.columns == ["doc_id", "text", "ids", "piece_ids", "decoded"]
    assert sorted(r.decoded for r in out.collect()) == ["", "a b", "a b"]


def test_rows_with_ids_are_aligned_with_their_texts(monkeypatch):
    seen, spans = [], PieceModel.spans
    monkeypatch.setattr(PieceModel, "spans", lambda self, text, ids: seen.append(text) or spans(self, text, ids))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": ["a  b", None, "naïve 😀"]})
    out = pa.Table.from_batches(pieces._rows_with_ids(PROTO, iter([batch])))
    assert seen == [b"a  b", b"", "naïve 😀".encode()]
    assert out.column("piece_ids").to_pylist() == [MODEL.encode([t])[0] for t in ("a  b", "", "naïve 😀")]
    monkeypatch.setattr(PieceModel, "spans", lambda self, text, ids: spans(self, text, ids)[:-1])
    with pytest.raises(ValueError):
        list(pieces._rows_with_ids(PROTO, iter([batch])))
