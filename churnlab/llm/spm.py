"""SentencePiece encoding and decoding on the tokenizers library."""

from __future__ import annotations

import os
import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.bpe import text_chunks
from churnlab.llm.common import picked

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
THREADS = 2
#: Bytes of texts encoded at a time (a longer text alone).
BATCH_BYTES = 250_000

# Fixed values of the model file's format: piece types, model types, the marker
# that stands for a space.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protobuf message: ints, 4- or 8-byte or delimited bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            if at == len(data):
                raise ValueError("not a SentencePiece model")
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(wire) if wire != 2 else varint()
        if size is None or at + size > len(data):
            raise ValueError("not a SentencePiece model")
        yield number, data[at : at + size]
        at += size


@dataclass(frozen=True)
class Model:
    """What a SentencePiece model file says."""

    pieces: tuple[tuple[str, float, int], ...]  # (piece, score, type), by id
    model_type: int
    byte_fallback: bool
    unk_id: int
    charsmap: bytes
    add_dummy_prefix: bool
    remove_extra_whitespaces: bool
    escape_whitespaces: bool


def parse_model(data: bytes) -> Model:
    pieces, trainer, normalizer = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            f = dict(_fields(value))
            pieces.append((f[1].decode(), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    unknown = [i for i, p in enumerate(pieces) if p[2] == UNKNOWN]
    if not unknown:
        raise ValueError("the model has no unknown piece")
    return Model(
        tuple(pieces), trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), unknown[0], normalizer.get(2, b""),
        bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1)), bool(normalizer.get(5, 1)),
    )


def _merges(model: Model) -> list[tuple[str, str]]:
    """Merge rules of a BPE model: every split of a piece into two pieces, best score first."""
    usable = {p: score for p, score, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
    rules = []
    for i, (piece, score, kind) in enumerate(model.pieces):
        if kind == NORMAL:
            rules += [(-score, i, cut, piece[:cut], piece[cut:]) for cut in range(1, len(piece)) if piece[:cut] in usable and piece[cut:] in usable]
    return [r[3:] for r in sorted(rules, key=lambda r: r[:3])]


def words_are_apart(model: Model) -> bool:
    """Whether no piece has the marker after another character, so that a text
    can be cut before each run of markers without changing its pieces. (Pieces
    that the user defined are found before all else, across words too.)"""
    kinds = {kind for _, _, kind in model.pieces}
    return model.escape_whitespaces and USER_DEFINED not in kinds and not any(SPACE in p.lstrip(SPACE) for p, _, kind in model.pieces if kind == NORMAL)


_words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall


def cut_words(text: str) -> list[str]:
    """A normalised text cut before each run of markers."""
    if SPACE + SPACE in text:
        return _words(text)
    first, *others = text.split(SPACE)
    words = [SPACE + w for w in others]
    return [first, *words] if first else words


def normaliser(model: Model):
    """The model's normalisation of a text, as a function on strings."""
    from tokenizers import normalizers

    charsmap = normalizers.Precompiled(model.charsmap) if model.charsmap else None

    def normalised(text: str) -> str:
        if charsmap:
            text = charsmap.normalize_str(text)
        if model.remove_extra_whitespaces:
            text = re.sub(" {2,}", " ", text.strip(" "))
        if text and model.add_dummy_prefix:
            text = " " + text
        return text.replace(" ", SPACE) if model.escape_whitespaces else text

    return normalised


def build_tokenizer(model: Model):
    """A tokenizers.Tokenizer for texts that are normalised by ``normaliser``."""
    from tokenizers import AddedToken, Tokenizer, decoders, models

    vocabulary = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    unknown = model.pieces[model.unk_id][0]
    if model.model_type == UNIGRAM:
        least = min((s for _, s, kind in model.pieces if kind == NORMAL), default=0.0)
        # Only normal and user-defined pieces may be found in a text.
        scores = [(p, s if kind in (NORMAL, USER_DEFINED) else least - 1e4) for p, s, kind in model.pieces]
        core = models.Unigram(scores, unk_id=model.unk_id, byte_fallback=model.byte_fallback)
    elif model.model_type == BPE:
        core = models.BPE(vocabulary, _merges(model), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        raise ValueError(f"model type {model.model_type}: only unigram and BPE models are supported")
    out = Tokenizer(core)
    decoding = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    out.decoder = decoders.Sequence(decoding + [decoders.Strip(" ", 1, 0)] * model.add_dummy_prefix)
    own = [AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER_DEFINED]
    if own:
        out.add_tokens(own)
    return out


class Codec:
    """Encodes and decodes texts; keeps a bounded number of words that it has
    met, so that each is encoded, and compared with the sentencepiece library,
    once. Where the two differ, the sentencepiece library's pieces are taken."""

    KEEP_WORDS = 300_000

    def __init__(self, data: bytes, threads: int = THREADS, parity: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"], os.environ["RAYON_NUM_THREADS"] = "true", str(threads)
        self.model = parse_model(data)
        self.tokenizer = build_tokenizer(self.model)
        self.normalised = normaliser(self.model)
        self.cut = cut_words if words_are_apart(self.model) else lambda text: [text] if text else []
        self.piece_texts = pa.array([p.replace(SPACE, " ") for p, _, _ in self.model.pieces], pa.string())
        self.is_byte = np.array([re.fullmatch("<0x..>", p) is not None for p, _, _ in self.model.pieces])
        self.reference = None
        if parity:
            import sentencepiece

            self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.forget()

    def forget(self) -> None:
        self.slots: defaultdict[str, int] = defaultdict()
        self.slots.default_factory = self.slots.__len__  # a new word takes the next slot
        self.ids, self.starts, self.differs = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, bool)
        self.texts: list[str] = []

    def _expected(self, words: list[str]) -> list[list[int]]:
        """What the sentencepiece library makes of normalised words with no marker but
        the first: a word that stands inside a text has its marker from a space, not
        from the prefix."""
        if not (self.model.escape_whitespaces and self.model.add_dummy_prefix):
            return self.reference.encode(words)
        return self.reference.encode([w.removeprefix(SPACE) for w in words])

    def _learn(self, words: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        differs = np.zeros(len(words), bool)
        if self.reference is not None:
            # Words that the library would itself change (a lone marker at a
            # text's start, trimmed space) are compared as part of whole texts.
            marked = self.model.add_dummy_prefix
            plain = [i for i, w in enumerate(words) if len(w) > marked and w.startswith(SPACE) == marked and w.rfind(SPACE) < marked]
            for i, ids in zip(plain, self._expected([words[i] for i in plain])):
                if ids != found[i]:
                    found[i], differs[i] = ids, True
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum()))
        self.texts += self._decoded_words(words, ids, lengths)
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.differs = np.concatenate([self.differs, differs])

    def _decoded_words(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> list[str]:
        """Words decoded from their ids: the texts of their pieces one after the other. The
        tokenizer's decoder takes words with pieces that stand for bytes, and those whose
        leading space is not in their pieces (it takes a leading space for a text's prefix)."""
        ends = np.concatenate([[0], np.cumsum(lengths)])
        pieces = self.piece_texts.take(pa.array(ids))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces), "")
        byte_pieces = np.concatenate([[0], np.cumsum(self.is_byte[ids])])
        rest = byte_pieces[ends[1:]] != byte_pieces[ends[:-1]]
        marked = self.model.add_dummy_prefix
        if marked:
            spaced = np.fromiter((w.startswith((SPACE, " ")) for w in words), bool, len(words))
            rest |= spaced != pc.starts_with(joined, " ").to_numpy(zero_copy_only=False)
        texts, at = joined.to_pylist(), rest.nonzero()[0].tolist()
        for i, text in zip(at, self.decode([ids[ends[i] : ends[i + 1]].tolist() for i in at])):
            texts[i] = " " + text if marked and spaced[i] else text
        return texts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """(ids of all texts, offsets of each text in them, whether its words
        agree with the library, the texts decoded from their ids)."""
        if len(self.slots) > self.KEEP_WORDS:
            self.forget()
        known, cut = len(self.slots), [self.cut(self.normalised(text)) for text in texts]
        at = list(map(self.slots.__getitem__, chain.from_iterable(cut)))
        if new := list(islice(self.slots, known, None)):
            self._learn(new)
        counts = list(map(len, cut))
        at, ends = np.array(at, np.int64), np.cumsum([0, *counts])
        first = self.starts[at]
        lengths = self.starts[at + 1] - first
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[np.repeat(first - upto[:-1], lengths) + np.arange(upto[-1])]
        wrong = np.concatenate([[0], np.cumsum(self.differs[at])])
        parts = list(map(self.texts.__getitem__, at.tolist()))
        first_char = int(self.model.add_dummy_prefix)
        decoded = ["".join(parts[a:b])[first_char:] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return ids, upto[ends], wrong[ends[1:]] == wrong[ends[:-1]], decoded

    def decode(self, rows: list) -> list[str]:
        return self.tokenizer.decode_batch(rows, skip_special_tokens=False)


@lru_cache(maxsize=1)
def _codec(data: bytes, threads: int, parity: bool) -> Codec:
    """Kept by a worker from task to task."""
    return Codec(data, threads, parity)


def _worker(batches, data: bytes, threads: int, parity: bool, schema: pa.Schema):
    codec = _codec(data, threads, parity)
    for part in text_chunks(batches, size=BATCH_BYTES):
        texts = [t or "" for t in part.column("text").to_pylist()]
        ids, offsets, agrees, decoded = codec.encode(texts)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("id"),
                pa.array(np.diff(offsets)),
                pa.LargeListArray.from_arrays(offsets, ids).cast(pa.list_(pa.int32())),
                pa.array(decoded, pa.string()),
                pa.array([a == b for a, b in zip(decoded, texts)], pa.bool_()),
                pa.array(agrees),
            ],
            schema=schema,
        )


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str = MODEL_FILE, threads: int = THREADS, parity: bool = True) -> DataFrame:
    """One row per document: id, n_tokens, ids, decoded, round_trip, parity.

    The model file is read once, on the driver (it is a few hundred kB), parsed
    from its protobuf form, and rebuilt on each worker as a tokenizer of the
    tokenizers library: normaliser, marker for spaces, scores (unigram) or
    merges in score order (BPE), byte fallback. Batches are encoded on
    ``threads`` threads. If no piece crosses a word's start, a text's pieces are
    those of its words, and a worker encodes and decodes each distinct word once.

    ``decoded`` is the text that the ids give back and ``round_trip`` whether it
    is the text that came in (models that normalise change it). With
    ``parity``, every distinct word is also encoded by the sentencepiece
    library; ``parity`` is false for a text with a word on which they differ, and its
    pieces are then the library's. Null texts are empty: no ids. Every input row
    gives one row; ids and repeated rows are passed through; no documents give
    no rows.
    """
    with open(model_file, "rb") as f:
        data = f.read()
    parse_model(data)  # a bad file fails here, not on the workers
    rows = picked(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    id_type = rows.schema["id"].dataType.simpleString()
    out = f"id {id_type}, n_tokens long, ids array<int>, decoded string, round_trip boolean, parity boolean"

    def run(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([("id", first.schema.field("id").type), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string()), ("round_trip", pa.bool_()), ("parity", pa.bool_())])
        yield from _worker(chain([first], batches), data, threads, parity, schema)

    return rows.mapInArrow(run, out)


def decoded(rows: DataFrame, ids_col: str = "ids", model_file: str = MODEL_FILE, threads: int = THREADS) -> DataFrame:
    """The rows with a column ``decoded``: the texts that their ids give. Null
    ids give an empty text."""
    with open(model_file, "rb") as f:
        data = f.read()

    @F.pandas_udf("string")
    def texts(column: pd.Series) -> pd.Series:
        return pd.Series(_codec(data, threads, False).decode([[] if ids is None else list(map(int, ids)) for ids in column]))

    return rows.withColumn("decoded", texts(F.col(f"`{ids_col}`")))
