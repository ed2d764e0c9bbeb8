import hashlib
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from churnlab.llm import alignment
from churnlab.llm.bpe import ByteBpe
from churnlab.llm.registry import op11_alignment
from tests.conftest import SF_SMALL

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        self.bytes_a = ByteBpe(A).bytes

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def align(self, text):
        """(n_a, n_b, groups, links) by comparing every two tokens near each other."""
        whole = b" " + (text or "").encode()
        a, b = self.a.encode(whole.decode(), add_special_tokens=False).ids, self.b.encode(text or "")
        if not text or b"".join(self.bytes_a[i] for i in a) != whole or b"".join(map(self.bytes_b, b)) != whole:
            return 0, 0, [], []
        ends_a, ends_b = np.cumsum([len(self.bytes_a[i]) for i in a]).tolist(), np.cumsum([len(self.bytes_b(i)) for i in b]).tolist()
        links, groups, i, j = [], [([], [])], 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            end = min(ends_a[i], ends_b[j])
            both = ends_a[i] == ends_b[j]
            if ends_a[i] == end:
                groups[-1][0].append(a[i])
                i += 1
            if ends_b[j] == end:
                groups[-1][1].append(b[j])
                j += 1
            if both:
                groups.append(([], []))
        return len(a), len(b), groups[:-1], links


def plain_rows(texts):
    plain = Plain()
    found = [plain.align(t) for t in texts]
    count = Counter(p for *_, links in found for p in set(links))
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    for n_a, n_b, groups, links in found:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        best = sum(count[p] == highest[p[0]] for p in links)
        yield n_a, n_b, len(groups), len(links), best, sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def same(frame, docs):
    docs = [tuple(r) for r in docs]
    got = [(r["id"], *(r[c] for c in COLUMNS)) for r in frame.collect()]
    want = [(d, *row) for (d, _), row in zip(docs, plain_rows([t for _, t in docs]))]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=order) == sorted(want, key=order)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    same(op11_alignment(spark, SF_SMALL).withColumnRenamed("doc_id", "id"), docs)


def test_odd_documents(odd_docs):
    same(alignment.aligned(odd_docs, A, B), odd_docs.select("doc_id", "text").collect())


def test_odd_texts(spark, monkeypatch):
    texts = ["<|endoftext|> a", "<s> </s> <unk>", "▁ a", "a▁b", "  two  spaces ", "日本語です", "🙂🙂 é ñ", "\x00\x01", "á", "line\nline\r\n\t", "x" * 3000, None, ""]
    docs = [(i, t) for i, t in enumerate(texts * 2)]
    same(alignment.aligned(spark.createDataFrame(docs, "doc_id long, text string"), A, B), docs)


def test_no_documents(no_docs):
    assert alignment.aligned(no_docs, A, B).collect() == []


def _chunk_rows(texts):
    batch = pa.RecordBatch.from_pydict({"id": range(len(texts)), "text": texts})
    return alignment._chunks([batch], A, B, pa.schema([("id", pa.list_(pa.int64())), *alignment._CHUNK]))


def test_memory_of_a_task_does_not_grow_with_its_batch():
    rng = np.random.default_rng(3)
    words = np.array([f"word{i}" for i in range(2000)])
    texts = [" ".join(rng.choice(words, 250)) for _ in range(3000)]  # 6 MB in one batch
    next(_chunk_rows(["a"]))
    tracemalloc.start()
    rows = sum(len(row.column(0)[0]) for row in _chunk_rows(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts)
    assert peak < 120e6


def test_tasks_of_a_worker_read_the_tokenizers_once(monkeypatch):
    read = []
    monkeypatch.setattr(alignment, "ByteBpe", lambda *args, **more: read.append(args) or ByteBpe(*args, **more))
    for _ in range(3):
        assert sum(len(row.column(0)[0]) for row in _chunk_rows(["one", "two words"])) == 2
    assert len(read) <= 1


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_pieces_are_independent_of_their_size(piece):
    rng = np.random.default_rng(piece)
    for _ in range(50):
        size = int(rng.integers(1, 60))
        a, b = (np.sort(np.append(rng.choice(np.arange(1, size), int(rng.integers(0, size)), replace=False), size)) if size > 1 else np.array([1]) for _ in range(2))
        links_a, links_b, end_a, end_b = alignment.overlaps(a, b, piece)
        want = {(i, j) for i in range(len(a)) for j in range(len(b)) if max(a[i - 1] if i else 0, b[j - 1] if j else 0) < min(a[i], b[j])}
        assert sorted(zip(links_a.tolist(), links_b.tolist())) == sorted(want)
        assert [a[i] for i in end_a] == [b[j] for j in end_b] == sorted(set(a.tolist()) & set(b.tolist()))


def test_merge_path_divides_the_merge():
    rng = np.random.default_rng(2)
    a, b = np.sort(rng.integers(0, 50, 40)), np.sort(rng.integers(0, 50, 30))
    merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
    found = alignment.merge_path(a, b, np.arange(71))
    assert found.tolist() == [sum(1 for _, side in merged[:d] if side == 0) for d in range(71)]


def test_counts_do_not_depend_on_chunks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40).select("doc_id", "text").collect()
    monkeypatch.setattr(alignment, "STORED_ROWS", 300)
    frame = spark.createDataFrame([tuple(r) for r in docs], "doc_id long, text string").repartition(5)
    same(alignment.aligned(frame, A, B), docs)
