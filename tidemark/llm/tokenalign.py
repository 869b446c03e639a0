"""Tokens of two tokenizers aligned over the bytes of each text, by products of sparse incidence matrices.

Tokens by bytes are two 0/1 matrices A and B in compressed sparse rows. The product A·Bᵀ, row by row after Gustavson, holds the
overlap of every two tokens that share bytes. Between two rows of it that share no column both tokenizations end: there one group
of tokens stops and the next begins. Ids by groups are two more matrices, whose product counts the links, all pairs of an A
and a B token of one group. Products of documents by chunks and chunks by id pairs then sum the links of a document.

Neither vocabulary looks across a run of spaces after another character, so texts are cut there, and equal chunks
are encoded and multiplied once. How many documents hold a pair is a sum over units of texts; each unit asks for each of its pairs
once, so a frequent pair is a row for each unit and no more.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.session import arrow_batches, materialize

A_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
B_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
#: Bytes of text of a unit, entries a product expands at a time, chunks a Python worker remembers, and chunks that are encoded together.
UNIT, EXPANDED, REMEMBERED, TOGETHER = 1 << 20, 1 << 18, 80_000, 64
#: Units of a stored file: Spark reads and writes up to thousands of rows of a file at once.
FILE_UNITS = 8
_SHIFT = 20  # bits of a B id within a pair


@dataclass
class Csr:
    """A sparse matrix by rows: row i has columns ``indices[indptr[i]:indptr[i + 1]]`` with values ``data``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    @classmethod
    def counted(cls, row: np.ndarray, column: np.ndarray, rows: int, columns: int) -> Csr:
        """Entry (i, j) is how often row i meets column j."""
        keys, counts = np.unique(row * columns + column, return_counts=True)
        indptr = np.searchsorted(keys, np.arange(rows + 1) * columns)
        return cls(indptr, keys % max(columns, 1), counts, columns)

    @classmethod
    def spans(cls, lengths: np.ndarray) -> Csr:
        """Row i covers the next ``lengths[i]`` columns."""
        indptr = np.concatenate(([0], np.cumsum(lengths)))
        total = int(indptr[-1])
        return cls(indptr, np.arange(total), np.ones(total, np.int64), total)

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        row = np.repeat(np.arange(self.rows), np.diff(self.indptr))
        indptr = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.columns))))
        return Csr(indptr, row[order], self.data[order], self.rows)


def product(left: Csr, right: Csr) -> Csr:
    """left · right by rows: each entry of a row of ``left`` brings a row of ``right``, equal columns add up.

    Rows are taken in blocks that expand to about ``EXPANDED`` entries, so memory follows the largest row.
    """
    width = np.diff(right.indptr)
    each = width[left.indices]
    ahead = np.concatenate(([0], np.cumsum(each)))
    upto = ahead[left.indptr]
    indptr, indices, data = [np.zeros(1, np.int64)], [], []
    first, total = 0, 0
    while first < left.rows:
        last = max(int(np.searchsorted(upto, upto[first] + EXPANDED, "right")) - 1, first + 1)
        a, b = left.indptr[first], left.indptr[last]
        count = each[a:b]
        at = np.repeat(right.indptr[left.indices[a:b]] - (ahead[a:b] - ahead[a]), count) + np.arange(int(count.sum()))
        row = np.repeat(np.repeat(np.arange(last - first), np.diff(left.indptr[first : last + 1])), count)
        key = row * right.columns + right.indices[at]
        value = np.repeat(left.data[a:b], count) * right.data[at]
        if len(key) and (np.diff(key) < 0).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        fresh = np.flatnonzero(np.diff(key, prepend=-1))
        kept = key[fresh]
        indices.append(kept % max(right.columns, 1))
        data.append(np.add.reduceat(value, fresh) if len(fresh) else value)
        indptr.append(total + np.searchsorted(kept, np.arange(1, last - first + 1) * right.columns))
        total += len(kept)
        first = last
    none = [np.zeros(0, np.int64)]
    return Csr(np.concatenate(indptr), np.concatenate(indices or none), np.concatenate(data or none), right.columns)


def overlaps(a_lengths: np.ndarray, b_lengths: np.ndarray) -> Csr:
    """A tokens by B tokens of one byte string: how many bytes they share."""
    return product(Csr.spans(a_lengths), Csr.spans(b_lengths).transposed())


def groups_of(shared: Csr) -> tuple[np.ndarray, np.ndarray]:
    """Group of each A token and of each B token: a group ends where the next row starts at a new column."""
    if not shared.rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    opening, closing = shared.indices[shared.indptr[:-1]], shared.indices[shared.indptr[1:] - 1]
    a_group = np.cumsum(np.concatenate(([False], opening[1:] != closing[:-1])))
    b_group = np.empty(shared.columns, np.int64)
    b_group[shared.indices] = np.repeat(a_group, np.diff(shared.indptr))
    return a_group, b_group


class Spelling:
    """The bytes of each id of a vocabulary."""

    def __init__(self, table: list[bytes]):
        self.raw, self.lengths = np.frombuffer(b"".join(table), np.uint8), np.array([len(x) for x in table], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths

    def of(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of these ids in a row."""
        each = self.lengths[ids]
        return self.raw[np.repeat(self.begins[ids] - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))]


class Tokenizers:
    """Both vocabularies: ids of texts, and the bytes of each id."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer, pre_tokenizers

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = sorted(pre_tokenizers.ByteLevel.alphabet())
        shown = sorted(x for x in letters if ord(x) < 256)
        byte_of = {x: ord(x) for x in shown} | dict(zip(letters[len(shown) :], (i for i in range(256) if chr(i) not in shown), strict=True))
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_spelling = Spelling([bytes(byte_of.get(c, 63) for c in self.a.id_to_token(i) or "") for i in range(size)])
        self.b_spelling = Spelling([self._piece(i) for i in range(self.b.vocab_size())])
        self.names = [f"{i}{after}" for after in ",|;" for i in range(max(size, self.b.vocab_size()))]

    def said(self, a_ids: np.ndarray, a_group: np.ndarray, b_ids: np.ndarray, b_group: np.ndarray) -> list[str]:
        """The tokens of all groups as ``a1,a2|b1;``, a string for each token in order."""
        order = np.argsort(np.concatenate((2 * a_group, 2 * b_group + 1)), kind="stable")
        a_last, b_last = (np.diff(x, append=-1) != 0 for x in (a_group, b_group))
        after = np.concatenate((a_last.astype(np.int64), 2 * b_last.astype(np.int64)))
        names = self.names
        return [names[k] for k in (np.concatenate((a_ids, b_ids)) + after * (len(names) // 3))[order].tolist()]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _come_back(self, raw: np.ndarray, edges: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Strings lie between ``edges`` and hold texts that stop at ``ends``. Which texts lie in strings that come back from the tokens
        of both vocabularies, with a token's end at each text's end; and of these, by vocabulary, ids and text of each token."""
        data = raw.tobytes()
        plain = [data[x:y].decode("utf-8", "replace") for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        sizes, string, good, tokens = np.diff(edges), np.searchsorted(edges, ends) - 1, np.ones(len(plain), bool), []
        for ids, table in (
            ([e.ids for e in self.a.encode_batch_fast(plain, add_special_tokens=False)], self.a_spelling),
            (self.b.encode([x[1:] for x in plain], num_threads=1), self.b_spelling),
        ):
            flat, _, owner = _flat(ids)
            same = np.bincount(owner, table.lengths[flat], len(plain)) == sizes
            flat, owner, kept = flat[same[owner]], owner[same[owner]], np.where(same, sizes, 0)
            stop = np.cumsum(table.lengths[flat]) + (edges[:-1] - (np.cumsum(kept) - kept))[owner]
            place = np.flatnonzero(np.repeat(same, sizes))
            same[np.searchsorted(edges, place[table.of(flat) != raw[place]], "right") - 1] = False
            closed = np.zeros(len(raw) + 1, bool)
            closed[stop] = True
            same[string[~closed[ends]]] = False
            good &= same
            tokens.append((flat, owner, stop))
        return good[string], [(flat[good[owner]], np.searchsorted(ends, stop[good[owner]])) for flat, owner, stop in tokens]

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each vocabulary: all ids of texts that begin with a space in a row, how many each text has, and the text of each id.

        There are none where the bytes of either vocabulary's tokens differ from the text. Neither looks across a space after another
        character, so texts are encoded some together and told apart by their bytes; one that does not come back is encoded again by itself.
        """
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        raw = np.frombuffer(b"".join(texts), np.uint8)
        if not len(texts):
            return [_flat([]), _flat([])]
        starts = np.concatenate(([0], ends[:-1]))
        alone = (np.add.reduceat(_other_space(raw), starts, dtype=np.int64) > 0) | tb.SPACE[raw[ends - 1]]
        opens = alone | (np.arange(len(texts)) % TOGETHER == 0)
        opens[1:] |= alone[:-1]
        good, tokens = self._come_back(raw, np.append(starts[opens], len(raw)), ends)
        again = np.flatnonzero(~good)
        if len(again):
            parts = [texts[k] for k in again.tolist()]
            edges = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
            _, more = self._come_back(np.frombuffer(b"".join(parts), np.uint8), edges, edges[1:])
            for k, ((ids, text), (new, place)) in enumerate(zip(tokens, more, strict=True)):
                text = np.concatenate((text, again[place]))
                order = np.argsort(text, kind="stable")
                tokens[k] = np.concatenate((ids, new))[order], text[order]
        return [(ids, np.bincount(text, minlength=len(texts)), text) for ids, text in tokens]


@functools.lru_cache(maxsize=2)
def _tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids in a row, how many each list has, and the list of each id."""
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(counts.sum()))
    return flat, counts, np.repeat(np.arange(len(ids)), counts)


@dataclass
class Chunks:
    """Aligned texts: of each the number of ids of A and B and of groups, the groups as text, and its id pairs, those of text i
    being ``pairs[edges[i]:edges[i + 1]]``, with the links of each pair."""

    counts: np.ndarray
    said: np.ndarray
    edges: np.ndarray
    pairs: np.ndarray
    amounts: np.ndarray

    @classmethod
    def joined(cls, parts: list[Chunks]) -> Chunks:
        width = np.concatenate([np.zeros(1, np.int64), *(np.diff(x.edges) for x in parts)])
        return cls(
            np.concatenate([np.zeros((0, 3), np.int64), *(x.counts for x in parts)]), np.concatenate([np.zeros(0, object), *(x.said for x in parts)]), np.cumsum(width),
            *(np.concatenate([np.zeros(0, np.int64), *(getattr(x, name) for x in parts)]) for name in ("pairs", "amounts")),
        )

    def take(self, rows: np.ndarray) -> Chunks:
        width = np.diff(self.edges)[rows]
        edges = np.concatenate(([0], np.cumsum(width)))
        at = np.repeat(self.edges[rows] - edges[:-1], width) + np.arange(int(edges[-1]))
        return Chunks(self.counts[rows], self.said[rows], edges, self.pairs[at], self.amounts[at])


def aligned_chunks(texts: list[bytes], tokenizers: Tokenizers) -> Chunks:
    """Groups and links of each text; a text that does not come back from its tokens has none, and an empty group text."""
    (a_ids, a_count, a_chunk), (b_ids, b_count, b_chunk) = tokenizers.encode(texts)
    a_group, b_group = groups_of(overlaps(tokenizers.a_spelling.lengths[a_ids], tokenizers.b_spelling.lengths[b_ids]))
    groups = int(a_group[-1]) + 1 if len(a_group) else 0
    a_keys, a_row = np.unique(a_chunk << _SHIFT | a_ids, return_inverse=True)
    b_keys, b_row = np.unique(b_chunk << _SHIFT | b_ids, return_inverse=True)
    links = product(Csr.counted(a_row, a_group, len(a_keys), groups), Csr.counted(b_row, b_group, len(b_keys), groups).transposed())
    low = (1 << _SHIFT) - 1
    pairs = np.repeat(a_keys & low, np.diff(links.indptr)) << _SHIFT | b_keys[links.indices] & low
    edges = links.indptr[np.searchsorted(a_keys >> _SHIFT, np.arange(len(texts) + 1))]
    firsts = np.searchsorted(a_group, np.arange(groups))
    counts = np.stack((a_count, b_count, np.bincount(a_chunk[firsts] if groups else firsts, minlength=len(texts))), axis=1)
    tokens, ends = tokenizers.said(a_ids, a_group, b_ids, b_group), np.concatenate(([0], np.cumsum(a_count + b_count))).tolist()
    said = np.array(["".join(tokens[x:y])[:-1] for x, y in itertools.pairwise(ends)], object)
    return Chunks(counts, said, edges, pairs, links.data.astype(np.int64))


class _Memory:
    """Chunks aligned in this Python worker by their hashes, in order: those used lately, between ``limit`` and twice as many."""

    def __init__(self, tokenizers: Tokenizers, limit: int = REMEMBERED):
        self.tokenizers, self.limit, self.turn = tokenizers, limit, 0
        self.hashes, self.used, self.chunks = np.zeros(0, np.uint64), np.zeros(0, np.int64), Chunks.joined([])

    def of(self, hashes: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> Chunks:
        """The chunks with these hashes, ascending and distinct, that lie in ``data``."""
        have, self.turn = len(self.hashes), self.turn + 1
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < have
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        self.used[at[known]] = self.turn
        new = np.flatnonzero(~known)
        at[new] = have + np.arange(len(new))
        texts = [data[x:y] for x, y in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
        both = Chunks.joined([self.chunks, *(aligned_chunks(texts[k : k + 10_000], self.tokenizers) for k in range(0, len(texts), 10_000))])
        short = new[(ends - starts)[new] <= 64]
        keys, used = np.concatenate((self.hashes, hashes[short])), np.concatenate((self.used, np.full(len(short), self.turn)))
        kept = np.argsort(used, kind="stable")[-self.limit if len(used) > 2 * self.limit else 0 :]
        kept = kept[np.argsort(keys[kept], kind="stable")]
        self.hashes, self.used, self.chunks = keys[kept], used[kept], both.take(np.concatenate((np.arange(have), at[short]))[kept])
        return both.take(at)


@functools.lru_cache(maxsize=2)
def _memory(a_path: str, b_path: str) -> _Memory:
    return _Memory(_tokenizers(a_path, b_path))


def _other_space(raw: np.ndarray) -> np.ndarray:
    """Marks the first byte of white space outside ASCII, and control characters that some take for it."""
    out = (raw >= 0x1C) & (raw <= 0x1F)
    if len(raw) > 1:
        out[:-1] |= (raw[:-1] == 0xC2) & np.isin(raw[1:], (0x85, 0xA0))
    if len(raw) > 2:
        x, y, z = raw[:-2], raw[1:-1], raw[2:]
        general = (y == 0x80) & ((z <= 0x8A) | np.isin(z, (0xA8, 0xA9, 0xAF))) | (y == 0x81) & (z == 0x9F)
        out[:-2] |= (x == 0xE1) & (y == 0x9A) & (z == 0x80) | (x == 0xE2) & general | (x == 0xE3) & (y == 0x80) & (z == 0x80)
    return out


def chunked(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts that are not empty, each after one space, and start, end and row of the chunks.

    A chunk starts at a space after a character that is no white space, but not at a text's last byte. A text with white space outside ASCII is one chunk.
    """
    lengths = np.diff(offsets)
    rows = np.flatnonzero(lengths)
    spaced = np.insert(raw, offsets[:-1][rows], 32)
    begins = np.cumsum(lengths[rows] + 1) - (lengths[rows] + 1)
    cut = np.zeros(len(spaced), bool)
    if len(spaced):
        before = spaced[:-1]
        cut[1:] = (spaced[1:] == 32) & (before != 32) & ((before < 9) | (before > 13))
        odd = np.add.reduceat(_other_space(spaced), begins, dtype=np.int64) > 0
        cut &= np.repeat(~odd, lengths[rows] + 1)
        cut[begins + lengths[rows]] = False
        cut[begins] = True
    starts = np.flatnonzero(cut)
    return spaced, starts, np.append(starts[1:], len(spaced)), rows[np.searchsorted(begins, starts, "right") - 1]


@dataclass
class Unit:
    """Alignment of some texts: counts of each, and links of each text (row) by the pairs of the unit (columns)."""

    tokens_a: np.ndarray
    tokens_b: np.ndarray
    groups: np.ndarray
    digests: list[str]
    pairs: np.ndarray
    links: Csr


def align_texts(raw: np.ndarray, offsets: np.ndarray, memory: _Memory) -> Unit:
    n = len(offsets) - 1
    spaced, starts, ends, rows = chunked(raw, offsets)
    hashes, firsts, places = np.unique(tb.span_hashes(spaced, starts, ends), return_index=True, return_inverse=True)
    chunks = memory.of(hashes, spaced.tobytes(), starts[firsts], ends[firsts])
    broken = chunks.counts[:, 0] == 0
    good = np.ones(n, bool)
    good[rows[broken[places]]] = False
    kept = good[rows]
    rows, places = rows[kept], places[kept]
    counts = [np.bincount(rows, chunks.counts[places, k], n).astype(np.int64) for k in range(3)]
    said, edges = chunks.said.tolist(), np.searchsorted(rows, np.arange(n + 1)).tolist()
    order = places.tolist()
    digests = [
        hashlib.sha256(";".join([said[k] for k in order[a:b]]).encode()).hexdigest() if a < b else ""
        for a, b in zip(edges[:-1], edges[1:], strict=True)
    ]
    pairs, columns = np.unique(chunks.pairs, return_inverse=True)
    by_chunk = Csr(chunks.edges, columns, chunks.amounts, len(pairs))
    links = product(Csr.counted(rows, places, n, len(hashes)), by_chunk)
    return Unit(*counts, digests, pairs, links)


_UNIT = (
    "unit long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, "
    "edge array<long>, place array<int>, link array<long>, pair array<long>, n array<long>"
)


def _unit_batches(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, number = _memory(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, last, raw, offsets in tb.pieces(batch.column(1), UNIT):
                unit = align_texts(raw, offsets, memory)
                held = np.bincount(unit.links.indices, minlength=len(unit.pairs))
                used = held > 0
                place = (np.cumsum(used) - 1)[unit.links.indices].astype(np.int32)
                values = [unit.tokens_a, unit.tokens_b, unit.groups, unit.digests, unit.links.indptr, place, unit.links.data, unit.pairs[used], held[used]]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                lists = [pa.array([x], pa.list_(kind)) for x, kind in zip(values, kinds, strict=True)]
                ids = batch.column(0).slice(first, last - first)
                whole = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), whole, *lists],
                    names=["unit", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "edge", "place", "link", "pair", "n"],
                )
                number += 1

    return run


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _sum_unit(units: pa.Table, answers: pa.Table) -> pa.Table:
    """Links of each document of a unit, those of its best pairs, and the sum of the pairs' counts."""
    row = {name: units.column(name).combine_chunks().flatten() for name in units.column_names if name != "unit"}
    place, edge, link = (row[x].to_numpy() for x in ("place", "edge", "link"))
    count, best = np.zeros(len(answers), np.int64), np.zeros(len(answers), np.int64)
    at = answers.column("at").to_numpy()
    count[at], best[at] = answers.column("count").to_numpy(), answers.column("best").to_numpy(zero_copy_only=False)

    def summed(values):
        return np.diff(np.concatenate(([0], np.cumsum(values)))[edge])

    return pa.table({
        "doc_id": row["doc_id"], "n_a": row["n_a"], "n_b": row["n_b"], "n_groups": row["n_groups"], "n_links": summed(link),
        "n_best": summed(link * best[place]), "count_sum": summed(link * count[place]), "groups_sha256": row["groups_sha256"],
    })


def pair_counts(units: DataFrame) -> DataFrame:
    """(pair, count, best): how many documents hold each id pair, and whether no pair of the same A id has more."""
    counts = units.select(F.arrays_zip("pair", "n").alias("x")).select(F.inline("x")).groupBy("pair").agg(F.sum("n").alias("count"))
    counts = materialize(counts, "pair-counts").withColumn("a", F.shiftright("pair", _SHIFT))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, a_vocabulary: str = A_VOCABULARY, b_vocabulary: str = B_VOCABULARY) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs`` (doc_id, text).

    Both tokenizers read one space and the text; the strings of special tokens are plain text. Byte offsets where a token of
    each ends cut the tokens into groups; links are all pairs of an A and a B token of one group. A pair's count is the number of
    documents that hold it. n_best counts the links whose count is the highest of their A id, ties included; count_sum adds the counts of the links.
    groups_sha256 is the digest of ``a1,a2|b1;a3|b2,b3``.

    NULL and empty texts, and texts that do not come back from the tokens of both (U+2581 becomes a space), have no tokens: zeros and an
    empty digest. Rows that repeat a doc_id or have none are documents of their own. An empty table gives an empty result;
    other columns are ignored. Whole texts are read; a long text is a unit of its own.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with arrow_batches(docs.sparkSession, 2 * UNIT):
        units = materialize(rows.mapInArrow(_unit_batches(a_vocabulary, b_vocabulary), _UNIT), "aligned", file_rows=FILE_UNITS)
    asked = units.select(F.col("unit").alias("asking"), F.posexplode("pair").alias("at", "pair"))
    answers = asked.join(pair_counts(units), "pair").select("asking", "at", "count", "best")
    bodies = units.drop("pair", "n")
    return bodies.groupBy("unit").cogroup(answers.groupBy("asking")).applyInArrow(_sum_unit, _RESULT)


_LINKS = "doc_id long, a_ids array<int>, b_ids array<int>, a_group array<int>, b_group array<int>, a_token array<int>, b_token array<int>, shared_bytes array<int>"


def aligned_tokens(docs: DataFrame, a_vocabulary: str = A_VOCABULARY, b_vocabulary: str = B_VOCABULARY) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_group, b_group, a_token, b_token, shared_bytes) of every row of ``docs`` (doc_id, text).

    The ids of both tokenizers, the group of each token, and the overlap links: a_token and b_token are positions of tokens that share
    shared_bytes bytes. Handles the same rows as ``align_documents``; texts without tokens have empty lists.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _tokenizers(a_vocabulary, b_vocabulary)
        for batch in batches:
            for row, text in enumerate(batch.column(1)):
                text = (text.as_py() or "").encode("utf-8", "replace")
                (a, _, _), (b, _, _) = tokenizers.encode([b" " + text] if text else [])
                shared = overlaps(tokenizers.a_spelling.lengths[a], tokenizers.b_spelling.lengths[b])
                token = np.repeat(np.arange(shared.rows), np.diff(shared.indptr))
                values = [a, b, *groups_of(shared), token, shared.indices, shared.data]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1), *(pa.array([np.asarray(v, np.int32)], pa.list_(pa.int32())) for v in values)],
                    names=["doc_id", "a_ids", "b_ids", "a_group", "b_group", "a_token", "b_token", "shared_bytes"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _LINKS)
