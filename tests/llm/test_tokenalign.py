import hashlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import tokenalign as ta
from tidemark.session import ARROW_BYTES_CONF, materialize

TEXTS = [
    None, "", " ", "  two  spaces  ", "plain words here", "tabs\tand\nlines\n\n  end \n", "no break   x   y", "日本語のテキスト です", "a▁b c", "<s> </s> <0x0A> <unk>",
    "<|endoftext|> again <|endoftext|>", "🙂🙃 x🙂", "naïve café", "\0 \x1c a", "1234567 12 3", "don't they'll", "same text here", "same text here", "x" * 3000, "abcdefghij" * 200, "  　b",
]


def plain_groups(text, a_model, b_model):
    if not text:
        return None
    whole = (" " + text).encode()
    a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
    chars = {chr(c): c for c in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    rest = [c for c in range(256) if c not in chars.values()]
    chars |= {chr(256 + i): c for i, c in enumerate(rest)}
    a_bytes = [bytes(chars[c] for c in a_model.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return None
    ends = [np.cumsum([len(x) for x in y]).tolist() for y in (a_bytes, b_bytes)]
    groups, x, y = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        s, t = ends[0].index(cut) + 1, ends[1].index(cut) + 1
        groups.append((a[x:s], b[y:t]))
        x, y = s, t
    return groups


def plain_rows(rows):
    a_model = Tokenizer.from_file(ta.A_VOCABULARY)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=ta.B_VOCABULARY)
    found = [(doc_id, plain_groups(text, a_model, b_model)) for doc_id, text in rows]
    links = [Counter((x, y) for a, b in groups or [] for x in a for y in b) for _, groups in found]
    counts = Counter(pair for one in links for pair in one)
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, groups), one in zip(found, links, strict=True):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or [])
        out.append((
            doc_id, sum(len(a) for a, _ in groups or []), sum(len(b) for _, b in groups or []), len(groups or []), sum(one.values()),
            sum(n for (x, y), n in one.items() if counts[x, y] == most[x]), sum(n * counts[pair] for pair, n in one.items()),
            hashlib.sha256(said.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


def test_aligned_documents_equal_the_plain_way(spark, rows):
    given_rows = [*enumerate(TEXTS), (None, "no id"), (3, "again the same id")]
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in given_rows], "doc_id long, text string, unit string, pair int, n string")
    assert rows(ta.align_documents(docs)) == plain_rows(given_rows)


def test_given_documents(spark, rows):
    path = "/root/testdata/sf0.001/documents.parquet"
    table = pq.read_table(path, columns=["doc_id", "text"])
    given_rows = list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))
    assert rows(ta.align_documents(spark.read.parquet(path).repartition(3))) == plain_rows(given_rows)


def test_empty_table(spark):
    assert ta.align_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert ta.aligned_tokens(spark.createDataFrame([(1, None)], "doc_id long, text string")).first().a_ids == []


def test_overlap_links_share_bytes(spark):
    docs = spark.createDataFrame([(1, "naïve café 🙂"), (2, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in ta.aligned_tokens(docs).collect()}
    one = got[1]
    assert sum(one.shared_bytes) == len(" naïve café 🙂".encode())
    assert all(one.a_group[x] == one.b_group[y] for x, y in zip(one.a_token, one.b_token, strict=True))
    assert got[2].a_token == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 5)), max_size=40), st.lists(st.tuples(st.integers(0, 5), st.integers(0, 4)), max_size=40), st.integers(1, 50))
def test_product_equals_dense(left, right, block):
    def both(entries, rows, columns):
        r, c = (np.array([e[k] for e in entries], np.int64) for k in (0, 1))
        dense = np.zeros((rows, columns), np.int64)
        np.add.at(dense, (r, c), 1)
        return ta.Csr.counted(r, c, rows, columns), dense

    (a, x), (b, y) = both(left, 7, 6), both(right, 6, 5)
    kept, ta.EXPANDED = ta.EXPANDED, block
    try:
        got = ta.product(a, b)
    finally:
        ta.EXPANDED = kept
    dense = np.zeros((7, 5), np.int64)
    dense[np.repeat(np.arange(7), np.diff(got.indptr)), got.indices] = got.data
    assert (dense == x @ y).all()
    assert all((np.diff(got.indices[s:t]) > 0).all() for s, t in zip(got.indptr[:-1], got.indptr[1:], strict=True))
    turned = b.transposed()
    again = np.zeros((5, 6), np.int64)
    again[np.repeat(np.arange(5), np.diff(turned.indptr)), turned.indices] = turned.data
    assert (again == y.T).all()


def test_chunks_are_encoded_together_and_met_once():
    class Watched:
        def __init__(self, tokenizer):
            self.tokenizer, self.seen = tokenizer, []

        def encode_batch_fast(self, texts, **options):
            self.seen.extend(texts)
            return self.tokenizer.encode_batch_fast(texts, **options)

    tokenizers = ta.Tokenizers(ta.A_VOCABULARY, ta.B_VOCABULARY)
    tokenizers.a = Watched(tokenizers.a)
    memory = ta._Memory(tokenizers)
    text = " ".join(f"word{k}" for k in range(1000)).encode()
    first = ta.align_texts(np.frombuffer(text, np.uint8), np.array([0, len(text)]), memory)
    assert len(tokenizers.a.seen) <= -(-1000 // ta.TOGETHER)
    again = ta.align_texts(np.frombuffer(text, np.uint8), np.array([0, len(text)]), memory)
    assert len(tokenizers.a.seen) <= -(-1000 // ta.TOGETHER) and again.digests == first.digests


PIECES = [*"ab1 \n\t.,'", "  ", "▁", "é", "日本", "🙂", "\u00a0", "\u3000", "\x1c", "<s>", "<|endoftext|>", "word", "\0", "\ufffd"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=8).map(lambda x: (" " + "".join(x)).encode()), max_size=12))
def test_texts_encoded_together_have_the_ids_of_each_alone(texts):
    tokenizers = ta._tokenizers(ta.A_VOCABULARY, ta.B_VOCABULARY)
    together, alone = tokenizers.encode(texts), [tokenizers.encode([t]) for t in texts]
    for k, (ids, count, owner) in enumerate(together):
        assert [x.tolist() for x in np.split(ids, np.cumsum(count))[:-1]] == [one[k][0].tolist() for one in alone]
        assert owner.tolist() == np.repeat(np.arange(len(texts)), count).tolist()


def test_forgotten_chunks_change_no_result():
    tokenizers = ta._tokenizers(ta.A_VOCABULARY, ta.B_VOCABULARY)
    small, plenty = ta._Memory(tokenizers, limit=2), ta._Memory(tokenizers)
    for text in ["one two three", "three four a▁b five six", "one two seven", "x" * 100 + " one", "three four"]:
        raw = np.frombuffer(text.encode(), np.uint8)
        a, b = (ta.align_texts(raw, np.array([0, len(raw)]), memory) for memory in (small, plenty))
        assert a.digests == b.digests and a.pairs.tolist() == b.pairs.tolist() and a.links.data.tolist() == b.links.data.tolist()
        assert len(small.hashes) <= 4 and len(small.chunks.said) == len(small.hashes)
    assert len(plenty.hashes) == 8


def test_units_are_met_in_small_batches_and_files(spark, monkeypatch):
    seen = {}

    def kept(df, label, **options):
        out = materialize(df, label, **options)
        most = out.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
        seen[label] = spark.conf.get(ARROW_BYTES_CONF, None), out.count(), most
        return out

    monkeypatch.setattr(ta, "materialize", kept)
    monkeypatch.setattr(ta, "UNIT", 1000)
    docs = spark.createDataFrame([(k, f"word{k} and more words " * 20) for k in range(100)], "doc_id long, text string").coalesce(1)
    assert ta.align_documents(docs).count() == 100
    size, units, most = seen["aligned"]
    assert size == "2000b" and units > ta.FILE_UNITS and most <= ta.FILE_UNITS
