"""Token ids against the tokenizer's own, and the training order under different splits."""

from __future__ import annotations

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from logloom.llm import order, packing, tokens


@pytest.fixture(scope="module")
def encode():
    return tokens.Encoder()


def _own(encode, text: str | None) -> bytes:
    return np.array(encode.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() if text else b""


def test_ids_of_random_texts_are_the_tokenizers(encode):
    draw = random.Random(5)
    letters = "ab's'trevmlld  \t\n\r09_.,!éßĀ'S<|"
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 30))) for _ in range(4000)]
    texts += [None, "", "'", "''s", "a's", "it's's", " 's", "\n's", "x'l", "y'", "'ll", "9're  ", " ", "  ", "a  ", "a \n b", "a\t b",
              "<|endoftext|>x", "日本 it's", "a b", "x" * 200_000, "word " * 50_000]
    for at in range(0, len(texts), 400):
        part = texts[at : at + 400]
        assert encode(part) == [_own(encode, t) for t in part]
    assert encode([]) == [] and encode([None, ""]) == [b"", b""]


def test_a_full_cache_starts_anew(encode, monkeypatch):
    monkeypatch.setattr(tokens, "SPLIT_CACHE", 3)
    for text in ("one two three four", "five one six", "one two"):
        assert encode([text]) == [_own(encode, text)]
        assert len(encode.known) <= 4


def test_a_known_split_is_looked_up_once(monkeypatch):
    class Looks(dict):
        n = 0

        def get(self, *args):
            Looks.n += 1
            return super().get(*args)

        def __getitem__(self, key):
            Looks.n += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            Looks.n += 1
            return super().__contains__(key)

    encode = tokens.Encoder()
    encode.known = Looks()
    text = "one two three two é four one"
    want = _own(encode, text)
    assert encode([text, text]) == [want, want]
    Looks.n = 0
    assert encode([text, text]) == [want, want]
    # one, " two", " three", " é", " four", " one"
    assert Looks.n == 6


def test_many_new_splits_are_learned_in_parts(encode, monkeypatch):
    monkeypatch.setattr(tokens, "LEARN", 3)
    texts = ["never seen words in parts of three", "zażółć qq1 qq2 qq3 qq4", "never qq4 qq5"]
    assert encode(texts) == [_own(encode, t) for t in texts]
    assert encode(texts[::-1]) == [_own(encode, t) for t in texts[::-1]]


@pytest.mark.parametrize("module", [order, packing])
def test_texts_are_encoded_few_at_a_time(monkeypatch, module):
    most = []

    def encode(texts):
        most.append(sum(len(t.encode()) for t in texts if t))
        return [b""] * len(texts)

    monkeypatch.setattr(module, "encoder", lambda path: encode)
    monkeypatch.setattr(module, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    n = 8000
    batch = pa.record_batch([pa.array(range(n)), pa.array(["x" * 1000] * n), pa.array([1] * n), pa.array(range(n))], names=["doc_id", "text", "file", "row"])
    run = order._cut(None, 0, 1024) if module is order else packing._packed(None, 0, 1024, 64)
    assert sum(b.num_rows for b in run(iter([batch]))) == n
    assert sum(most) == n * 1000 and max(most) <= 1 << 20


def _place(spark, folder, out, split_bytes):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        docs = spark.read.parquet(folder)
        order.materialise(docs, out, length=16, shard_rows=32, place=order.stored_place())
        return docs.rdd.getNumPartitions(), {r.slot: (r.doc_id, r.start, r.length, bytes(r.ids)) for r in order.read(spark, out, shard_rows=32).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_slots_do_not_depend_on_the_splits(spark, tmp_path, encode):
    draw = random.Random(3)
    texts = {i: None if i % 50 == 7 else " ".join(f"w{draw.randrange(999)}" for _ in range(draw.randrange(40))) for i in range(600)}
    for part in range(3):
        ids = [i for i in texts if i % 3 == part]
        table = pa.table({"doc_id": ids, "text": [texts[i] for i in ids], "file": ["x"] * len(ids)})
        (tmp_path / "docs").mkdir(exist_ok=True)
        pq.write_table(table, tmp_path / "docs" / f"part-{part}.parquet", row_group_size=20)
    folder = f"file://{tmp_path}/docs"
    few, whole = _place(spark, folder, f"file://{tmp_path}/a", 1 << 27)
    many, small = _place(spark, folder, f"file://{tmp_path}/b", 2048)
    assert many > 2 * few and whole == small and sorted(whole) == list(range(len(whole)))
    # every document's ids, whole and in order
    found: dict[int, bytes] = {}
    for doc_id, start, length, ids in sorted(whole.values()):
        assert start * 2 == len(found.get(doc_id, b"")) and set(ids[2 * length :]) <= {0} and len(ids) == 32
        found[doc_id] = found.get(doc_id, b"") + ids[: 2 * length]
    want = {i: np.append(np.frombuffer(_own(encode, t), "<u4"), 0).astype("<u2").tobytes() for i, t in texts.items()}
    assert found == want


def test_no_documents(spark, tmp_path):
    pq.write_table(pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())}), tmp_path / "none.parquet")
    _, found = _place(spark, f"file://{tmp_path}/none.parquet", f"file://{tmp_path}/o", 1 << 27)
    assert found == {}
