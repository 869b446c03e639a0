import functools
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing


def best_fit(lengths, capacity):
    bins = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, used in enumerate(bins) if used + length <= capacity]
        if fitting:
            bins[max(fitting, key=lambda i: bins[i])] += length
        else:
            bins.append(length)
    return len(bins)


def check_sequences(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def packed(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, unit string, number string, sequence_id string")
    return [r.asDict() for r in packing.pack_documents(docs, **options).collect()]


def test_pieces_follow_the_tokenizer_and_sequences_have_no_gaps(spark):
    texts = [
        None, "", "  \t\n", "Hello World, it's 2024!", "a b　c", "ÄÖÜ İstanbul ΣΟΦΟΣ", "<|endoftext|> x<|startoftext|>", "é ́", "\0 x",
        "word " * 5000, "x" * 30000, "same", "same", "日本語のテキスト",
    ]
    rows = [(i, t, "a", "b", "c", "d") for i, t in enumerate(texts)] + [(None, "no id", None, None, None, None), (3, "again", None, None, None, None)]
    got = packed(spark, rows, size=256)
    plain = Tokenizer.from_file(packing.VOCABULARY)
    wanted = []
    for doc_id, text, *_ in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 256):
            part = np.array(ids[k : k + 256], "<u4")
            wanted.append((doc_id, k // 256, k, len(part), zlib.crc32(part.tobytes())))
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(wanted, key=key)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    sequences = check_sequences(got, 256)
    assert sequences <= best_fit([w[3] for w in wanted], 256)


def test_empty_table(spark):
    assert packed(spark, []) == []


def test_given_documents_reach_the_bound(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    texts = pq.read_table(path, columns=["text"])["text"].to_pylist()
    got = [r.asDict() for r in packing.pack_documents(spark.read.parquet(path)).drop("ids").collect()]
    plain = Tokenizer.from_file(packing.VOCABULARY)
    assert sum(r["length"] for r in got) == sum(len(e.ids) + 1 for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False))
    assert check_sequences(got, packing.SEQUENCE) <= -(-sum(r["length"] for r in got) // packing.SEQUENCE) + 1


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=120))
def test_plan_places_every_piece_once(lengths):
    capacity = 60
    counts = np.bincount(lengths, minlength=capacity + 1) if lengths else np.zeros(capacity + 1, int)
    plan = packing.pack_lengths(counts, capacity)
    length = np.repeat(np.arange(capacity + 1), counts)
    number = np.concatenate([np.arange(n) for n in counts])
    rows = [{"sequence_id": s, "offset": o, "length": n} for s, o, n in zip(*(x.tolist() for x in (*plan.place(length, number), length)), strict=True)]
    assert check_sequences(rows, capacity) == plan.sequences
    assert plan.sequences <= best_fit(lengths, capacity) * 1.1 + 1


@pytest.mark.parametrize("low,high", [(650, 720), (20, 1400)])
def test_fractional_solution_is_near_its_bound(low, high):
    counts = np.bincount(np.random.default_rng(0).integers(low, high, 5000), minlength=2049)
    plan = packing.pack_lengths(counts, 2048)
    _, bound = packing.fractional(counts, 2048)
    assert bound <= plan.sequences <= 1.06 * bound


whole_tokenizer = functools.cache(lambda: Tokenizer.from_file(packing.VOCABULARY))
PARTS = [*"abA1 2.,!'s<|>\n", "≠", "é", "×", "ß", "É", "\u0301", "\u0338", "\u0307", "İ", "一", "\u00a0", "»", "<|endoftext|>", "'ll", "ΑΣ"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=20).map("".join), max_size=4))
def test_spans_give_the_ids_of_whole_texts(texts):
    data = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(d) for d in data]))).astype(np.int64)
    ids, edges = packing.token_ids(np.frombuffer(b"".join(data), np.uint8), offsets, packing._encoder(packing.VOCABULARY))
    plain = whole_tokenizer()
    assert [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)] == [plain.encode(t, add_special_tokens=False).ids + [0] for t in texts]


def test_plain_spans_are_encoded_once_and_without_the_normalizer():
    encoder = packing.Encoder(packing.VOCABULARY)
    by_itself, together = [], []

    def watched(tokenizer, seen):
        class Watched:
            def encode_batch_fast(self, texts, **options):
                seen.extend(texts)
                return tokenizer.encode_batch_fast(texts, **options)

        return Watched()

    encoder.whole, encoder.single = watched(encoder.whole, by_itself), watched(encoder.single, together)
    text = "Größe 12 größe GRÖSSE ÉTÉ-été l'été a\u0301 × ß<|x|>".encode()
    for _ in range(2):
        ids, _ = packing.token_ids(np.frombuffer(text, np.uint8), np.array([0, len(text)]), encoder)
        assert ids.tolist() == whole_tokenizer().encode(text.decode(), add_special_tokens=False).ids + [0]
    assert sorted(x for part in together for x in part.split()) == sorted(["größe", "1", "2", "grösse", "été", "-"])
    assert sorted(by_itself) == sorted(["l'été", "a\u0301", "×", "ß<|x|>"])


def test_forgotten_spans_change_no_ids():
    encoder = packing.Encoder(packing.VOCABULARY, limit=3)
    for text in ["one two été", "three 4 five's", "one 4 six × seven eight", "", "été two nine", "× one"]:
        raw = np.frombuffer(text.encode(), np.uint8)
        ids, _ = packing.token_ids(raw, np.array([0, len(raw)]), encoder)
        assert ids.tolist() == whole_tokenizer().encode(text, add_special_tokens=False).ids + [0]
        assert len(encoder.hashes) <= 2 * encoder.limit + 6
        assert (np.diff(encoder.hashes.astype(object)) > 0).all() and len(encoder.ids) == 1 + encoder.count.sum()
