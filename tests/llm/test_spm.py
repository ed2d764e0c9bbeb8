import os
import struct

import pytest
import sentencepiece

from churnlab.llm.spm import BPE, BYTE, CONTROL, MODEL_FILE, NORMAL, UNIGRAM, UNKNOWN, Codec, decoded, encoded, parse_model

needs_model = pytest.mark.skipif(not os.path.exists(MODEL_FILE), reason="no vocabulary file")

TEXTS = [
    "", " ", "  two  spaces ", "\n", "\t tab\r\nline", "▁marker ▁", "aaaa aaaaa aaaaaaa", "%%%% ### $$$$$", "<s> </s> <unk> <0x0A>", "\x00", "日本語 🙂 𝔘 é́",
    "Haus, Häuser. THE THE!!", "x" * 3000, "word " * 2000, "a b c", "ﬁne ① ½ Å",
]


@needs_model
def test_bpe_parity():
    with open(MODEL_FILE, "rb") as f:
        data = f.read()
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    for parity in (False, True):
        codec = Codec(data, parity=parity)
        ids, offsets, agrees, decoded = codec.encode(TEXTS)
        rows = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
        assert rows == reference.encode(TEXTS)
        assert agrees.all()
        assert decoded == codec.decode(rows) == reference.decode(rows)
        # The marker itself comes back as the space that it stands for.
        assert decoded == [t.replace("▁", " ") for t in TEXTS]


def _number(field, value):
    out = bytes([field << 3]) if field < 16 else bytes([(field << 3) & 127 | 128, field >> 4])
    while value > 127:
        out, value = out + bytes([value & 127 | 128]), value >> 7
    return out + bytes([value])


def _bytes(field, value):
    size, out = len(value), bytes([field << 3 | 2])
    while size > 127:
        out, size = out + bytes([size & 127 | 128]), size >> 7
    return out + bytes([size]) + value


def model_file(pieces, kind, byte_fallback, **normalizer):
    """A SentencePiece model made by hand: pieces with scores, nothing is trained."""
    out = b""
    for piece, score, type_ in pieces:
        out += _bytes(1, _bytes(1, piece.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + _number(3, type_))
    trainer = _number(3, kind) + _number(35, int(byte_fallback))
    norm = _bytes(1, b"identity") + b"".join(_number(f, normalizer[n]) for f, n in ((3, "prefix"), (4, "trim"), (5, "escape")) if n in normalizer)
    return out + _bytes(2, trainer) + _bytes(3, norm)


PIECES = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL), ("</s>", 0.0, CONTROL)]
WORDS = [("▁the", -2.0), ("▁", -3.0), ("ab", -3.5), ("▁a", -3.2), ("abc", -4.0), ("the", -4.1), ("a", -5.0), ("b", -5.1), ("c", -5.2), ("t", -5.3), ("h", -5.4), ("e", -5.5), ("▁ab", -4.4), ("bc", -4.6)]


@pytest.mark.parametrize("prefix", [0, 1])
@pytest.mark.parametrize("trim", [0, 1])
@pytest.mark.parametrize("fallback", [False, True])
def test_unigram_parity(prefix, trim, fallback):
    pieces = PIECES + [(f"<0x{i:02X}>", 0.0, BYTE) for i in range(256) if fallback] + [(p, s, NORMAL) for p, s in WORDS]
    data = model_file(pieces, UNIGRAM, fallback, prefix=prefix, trim=trim)
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    codec = Codec(data)
    texts = ["the abc", "abcabc the the", " ab  abc ", "thethe", "", "zzz the zz", "héa", "a b c", "   "]
    ids, offsets, _, decoded = codec.encode(texts)
    rows = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert rows == reference.encode(texts)
    assert decoded == codec.decode(rows)
    if fallback:
        assert decoded == reference.decode(rows)


def test_bpe_made_by_hand():
    data = model_file(PIECES + [(p, s, NORMAL) for p, s in WORDS], BPE, False, prefix=1, trim=0)
    reference, codec = sentencepiece.SentencePieceProcessor(model_proto=data), Codec(data)
    texts = ["the abc", "abcabc", "abab  ab", "zz abc"]
    ids, offsets, *_ = codec.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == reference.encode(texts)


@pytest.mark.parametrize("data", [b"\x00\x01\x02", b"\x0a\xff\x01abc", b""])
def test_bad_files_are_refused(data):
    with pytest.raises(ValueError):
        parse_model(data)


@needs_model
def test_odd_rows(odd_docs, no_docs):
    rows = encoded(odd_docs).collect()
    texts = sorted((r["text"] or "") for r in odd_docs.select("text").collect())
    assert sorted(r["decoded"] for r in rows) == texts
    assert all(r["round_trip"] and r["parity"] and r["n_tokens"] == len(r["ids"]) for r in rows)
    assert encoded(no_docs).count() == 0
    again = decoded(encoded(odd_docs).select("ids")).collect()
    assert sorted(r["decoded"] for r in again) == texts


def test_cut_words_at_each_run_of_markers():
    from churnlab.llm.spm import SPACE, cut_words

    for text in ("", "a", "▁", "▁a▁b", "a▁", "▁▁a▁▁▁b▁", "a▁▁b", "▁a b▁c"):
        words = cut_words(text)
        assert "".join(words) == text and all(words)
        assert all(w.startswith(SPACE) for w in words[1:]) and not any(SPACE in w.lstrip(SPACE) for w in words)
        assert not any(w.strip(SPACE) == "" for w in words[:-1])


@needs_model
def test_only_words_with_byte_pieces_take_the_decoder(monkeypatch):
    with open(MODEL_FILE, "rb") as f:
        codec = Codec(f.read())
    taken, decode = [], codec.decode
    monkeypatch.setattr(codec, "decode", lambda rows: taken.extend(rows) or decode(rows))
    texts = ["the word the", "a 𝔘 word", "日 <0x0A>"]
    *_, decoded = codec.encode(texts)
    assert decoded == texts
    assert 0 < len(taken) <= 2 and all(codec.is_byte[rows].any() for rows in taken)


@needs_model
def test_long_texts_are_encoded_few_at_a_time(monkeypatch):
    import pyarrow as pa

    from churnlab.llm import spm

    texts = [f"{i} " + "word " * 4000 for i in range(60)] + ["long " * 80_000, None, "", "end"]
    sizes, encode = [], Codec.encode
    monkeypatch.setattr(Codec, "encode", lambda self, own: sizes.append(len(own) > 1 and sum(map(len, own))) or encode(self, own))
    with open(MODEL_FILE, "rb") as f:
        data = f.read()
    schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string()), ("round_trip", pa.bool_()), ("parity", pa.bool_())])
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    rows = [r for part in spm._worker([batch], data, 2, True, schema) for r in part.to_pylist()]
    assert [r["decoded"] for r in rows] == [t or "" for t in texts] and [r["id"] for r in rows] == list(range(len(texts)))
    assert len(sizes) > 4 and max(sizes) <= 400_000
