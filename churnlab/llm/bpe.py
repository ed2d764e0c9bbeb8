"""Byte-level BPE ids of many texts by the tokenizers library, each distinct word of a chunk encoded once."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time (at least one text).
CHUNK_BYTES = 16 << 20
#: Bytes of words that the library is given as one text.
JOINED_BYTES = 4096

# White space of any library in UTF-8, by its bytes; a few other characters that
# end like it are taken for it, too, which only makes longer words.
_BLANK = np.zeros(256, bool)
_BLANK[[*range(0x00, 0x21), 0x7F]] = True
_LAST_OF_THREE = np.zeros(256, bool)
_LAST_OF_THREE[[*range(0x80, 0x90), 0x9F, 0xA8, 0xA9, 0xAF, 0xBF]] = True


def words_are_apart(data: str) -> bool:
    """Whether a tokenizer file's ids of a text are those of its words, cut before
    single spaces: the usual byte-level pattern, nothing before it, no added token
    that takes spaces. There a pretoken ends before a space that follows anything
    but white space, whatever comes next."""
    spec = json.loads(data)
    split = spec.get("pre_tokenizer") or {}
    added = [t for t in spec.get("added_tokens") or [] if t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]]
    byte_level = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    return bool(byte_level) and not spec.get("normalizer") and not spec["model"].get("dropout") and not added


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts in a row, where each starts and the last one ends); null: empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[ends[0] : ends[-1]], ends - ends[0]


def _ends_blank(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the bytes before the places ``at`` end a white-space character (or none)."""
    last, second, third = (np.where(at >= i, data[np.maximum(at, i) - i], 0x20) for i in (1, 2, 3))
    two = (second == 0xC2) & ((last == 0x85) | (last == 0xA0))
    three = _LAST_OF_THREE[last] & np.isin(third, (0xE1, 0xE2, 0xE3, 0xEF))
    return _BLANK[last] | two | three


def _strings(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(np.ascontiguousarray(ends)), pa.py_buffer(np.ascontiguousarray(data)))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of runs of the given starts and lengths, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, int(starts.max(initial=0)) + total) < 1 << 31 else np.int64
    out = np.repeat((starts - ends + lengths).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


class ByteBpe:
    """Encodes texts without the tokens that a post-processor adds.

    With ``specials_as_text`` the strings of special tokens are plain text. Memory
    is bounded by the texts of a call (see ``text_chunks``).
    """

    def __init__(self, path: str, specials_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            data = file.read()
        self.tokenizer = Tokenizer.from_str(data)
        self.tokenizer.encode_special_tokens = specials_as_text
        self.apart = words_are_apart(data)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        pieces = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        own = self._byte_of_char()
        #: The bytes of each id.
        self.bytes = [bytes(map(own.__getitem__, pieces.get(i, ""))) if self.apart else b"" for i in range(size)]
        for i, added in self.tokenizer.get_added_tokens_decoder().items():
            self.bytes[i] = added.content.encode()
        self.n_bytes = np.array([len(b) for b in self.bytes], np.int64)

    @staticmethod
    def _byte_of_char() -> dict[str, int]:
        """The byte that each character of a byte-level vocabulary stands for:
        printable Latin-1 characters are themselves, the others follow from 256."""
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in plain]
        return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}

    def _of_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words: those with a space before and none behind stand in
        one text, whose tokens end where the words do."""
        data, ends = text_buffers(words)
        starts, sizes = ends[:-1], np.diff(ends)
        joins = np.flatnonzero((sizes > 1) & (data[np.minimum(starts, len(data) - 1)] == 0x20) & ~_ends_blank(data, ends[1:]))
        alone = np.setdiff1d(np.arange(len(words)), joins)
        joined = data[spread(starts[joins], sizes[joins])]
        word_ends = np.cumsum(sizes[joins])
        cuts = np.unique(np.searchsorted(word_ends, np.arange(JOINED_BYTES, len(joined) + JOINED_BYTES, JOINED_BYTES), side="left")) if len(joins) else []
        places = np.unique([0, *(word_ends[np.minimum(cuts, len(joins) - 1)] if len(joins) else []), len(joined)])
        blob = joined.tobytes()
        ids, _ = self._of_batch([blob[a:b].decode("utf-8") for a, b in zip(places, places[1:])])
        token_ends = np.cumsum(self.n_bytes[ids])
        upto = np.searchsorted(token_ends, word_ends, side="right")
        if len(joins) and not (token_ends[upto - 1] == word_ends).all():
            raise ValueError("a token goes over the end of a word: this tokenizer's words are not apart")
        rest, rest_lengths = self._of_batch(words.take(pa.array(alone)).to_pylist())
        lengths = np.zeros(len(words), np.int64)
        lengths[joins], lengths[alone] = np.diff(upto, prepend=0), rest_lengths
        place = np.zeros(len(words), np.int64)
        place[joins], place[alone] = upto - lengths[joins], len(ids) + np.cumsum(rest_lengths) - rest_lengths
        return np.concatenate([ids, rest])[spread(place, lengths)], lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text); null: empty."""
        if not self.apart:
            return self._of_batch(pc.fill_null(texts.cast(pa.large_string()), "").to_pylist())
        data, ends = text_buffers(texts)
        spaces = np.flatnonzero(data == 0x20)
        cut = np.zeros(len(data) + 1, bool)
        cut[spaces[~_ends_blank(data, spaces)]] = cut[ends] = True
        cuts = np.flatnonzero(cut)
        if len(cuts) < 2:
            return np.zeros(0, np.uint32), np.zeros(len(ends) - 1, np.int64)
        coded = _strings(data, cuts).dictionary_encode()
        ids, lengths = self._of_words(coded.dictionary)
        at = coded.indices.to_numpy(zero_copy_only=False)
        starts = np.cumsum(lengths) - lengths
        text_ends = np.concatenate([[0], np.cumsum(lengths[at])])[np.searchsorted(cuts, ends)]
        return ids[spread(starts[at], lengths[at])], np.diff(text_ends)


def text_chunks(batches, column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with about ``size`` bytes of text (a longer text is
    a slice of its own)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
