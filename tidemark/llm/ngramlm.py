"""A bigram model as a weighted backoff automaton, learnt from and applied to whole corpora.

States are the frequent words, one state for all rare words, one for the start, and the empty history. A state has an arc for
every class of word seen after it, with the smoothed probability, and a failure arc to the empty history with
the weight that smoothing leaves to unseen classes; the empty history has an arc for every word. A text is read once from left to
right: take the arc, or the failure arc and then the empty history's arc, add the log, go to the word's state.

The automaton is too large for any one place, so it is met by request. Texts are dealt into units of bounded
size. A unit asks for each different word, and then, when it knows which are frequent, for each different pair of classes, once; requests go by ranges
of the hash to tasks that add the training counts up and answer with the sums. A frequent word is one
request per unit, so no task gets more for it than there are units. Nothing goes to every task but four sums. A word is frequent from
``LEAST_FREQUENT`` training tokens on, whatever the size of the corpus, so equal counts make equal states.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.session import scratch_path

FOLDS, HELD_OUT = 5, 1
ADDED = 0.5
#: Training tokens from which a word has a state of its own; strength of the backoff distribution.
LEAST_FREQUENT, STRENGTH = 5, 100.0
#: Bytes of text of a unit; bytes of text for each range of word hashes, and ranges of pairs for one of words.
UNIT, RANGE, PAIR_RANGES = 4 << 20, 8 << 20, 4
#: Bits that tell the pairs of one range apart.
PAIR_BITS = 40
_START, _END, _RARE = (np.uint64(x) for x in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xD1B54A32D192ED03))

BODY, WORDS, WORD_COUNTS, TOTALS, PAIRS, PAIR_COUNTS = range(6)
_ROW = "unit long, kind int, part int, a binary, b binary, c binary, d binary, e binary"
_SCHEMA = pa.schema([("unit", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), *((c, pa.binary()) for c in "abcde")])


def _rows(rows: list[tuple]) -> pa.Table:
    rows = [(*r, *([None] * (len(_SCHEMA) - len(r)))) for r in rows]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_SCHEMA)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _SCHEMA.types, strict=True)], schema=_SCHEMA)


def _pack(x: np.ndarray, width: int) -> bytes:
    """Whole numbers under 256^width byte by byte, low bytes of all first: sorted or small ones compress."""
    data = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 4).compress(data, asbytes=True)


def _unpack(data: bytes, width: int) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], size, asbytes=True), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1).astype(np.uint64)


def _parts_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _requests(unit: int, kind: int, part: np.ndarray, keys: np.ndarray, counts: np.ndarray, width: int) -> list[tuple]:
    """A row for each range that the sorted keys fall in, each key as its distance to the one before."""
    cuts = np.append(np.flatnonzero(np.diff(part, prepend=np.uint64(1 << 40))), len(part))
    return [(unit, kind, int(part[a]), _pack(np.diff(keys[a:b], prepend=np.uint64(0)), width), _pack(counts[a:b], 4)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units of whole texts: their tokens as places among the unit's words, commonest first, and the words."""
    number = TaskContext.get().partitionId() << 32
    held: list[tuple] = []
    size = 0

    def flush():
        hashes, lengths, ids, flags = (np.concatenate(x) for x in zip(*held, strict=True))
        keys, places, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")  # small numbers for common words pack well
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.arange(len(keys))
        row = (number, BODY, -1, ids.tobytes(), _pack(lengths, 6), _pack(rank[places], 4), flags.tobytes(), _pack(keys[order], 8))
        return _rows([row]).to_batches()

    for batch in batches:
        ids = batch.column(1)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        train = batch.column(2).to_numpy(zero_copy_only=False)
        for first, last, raw, offsets in tb.pieces(batch.column(0)):
            raw = tb.LOWER[raw]
            starts, ends, rows = tb.words(raw, offsets)
            lengths = tb.lengths_by_row(rows, last - first) + 1
            stops = np.cumsum(lengths) - 1
            hashes = np.full(int(lengths.sum()), _END, np.uint64)
            inner = np.ones(len(hashes), bool)
            inner[stops] = False
            hashes[inner] = tb.word_hashes(raw, starts, ends)
            flags = (train[first:last].astype(np.uint8)) | (known[first:last].astype(np.uint8) << 1)
            held.append((hashes, lengths, ids[first:last], flags))
            size += len(raw) + 16 * (last - first)
            if size >= UNIT:
                yield from flush()
                held, size, number = [], 0, number + 1
    if held:
        yield from flush()


class _Unit:
    """One unit's texts and words, these in the order of their hashes."""

    def __init__(self, ids: bytes, lengths: bytes, tokens: bytes, flags: bytes, keys: bytes):
        self.ids, self.flags = np.frombuffer(ids, np.int64), np.frombuffer(flags, np.uint8)
        self.lengths = _unpack(lengths, 6).astype(np.int64)
        found = _unpack(keys, 8)
        order = np.argsort(found, kind="stable")
        place = np.empty(len(found), np.int64)
        place[order] = np.arange(len(found))
        self.tokens, self.keys = place[_unpack(tokens, 4).astype(np.int64)], found[order]
        self.firsts = np.cumsum(self.lengths) - self.lengths
        self.train = np.repeat(self.flags & 1, self.lengths)

    def pairs(self, frequent: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted different pairs (range, then its bits), and each token's place among them; ``frequent`` marks the words that are states."""
        here = np.where(frequent, self.keys, _RARE)[self.tokens]
        before = np.append(_START, here[:-1])
        before[self.firsts] = _START
        mixed = tb.mix(before * np.uint64(0x9E3779B97F4A7C15) ^ here)
        codes = (_parts_of(mixed, parts) << np.uint64(PAIR_BITS)) | (mixed & np.uint64((1 << PAIR_BITS) - 1))
        return np.unique(codes, return_inverse=True)


def _units_of(batch: pa.RecordBatch) -> Iterator[tuple[int, _Unit]]:
    for row in range(batch.num_rows):
        yield batch.column(0)[row].as_py(), _Unit(*(batch.column(i)[row].as_py() for i in range(3, 8)))


def _ask_words(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, unit in _units_of(batch):
                counts = np.bincount(unit.tokens, unit.train, len(unit.keys))
                yield from _rows(_requests(number, WORDS, _parts_of(unit.keys, parts), unit.keys, counts, 8)).to_batches()

    return run


def _unit_of(table: pa.Table) -> tuple[int, _Unit, np.ndarray]:
    """A unit's number, the unit, and the training counts of its words, from its body and the answers to it."""
    kind = table.column("kind").to_numpy()
    body = int(np.flatnonzero(kind == BODY)[0])
    unit = _Unit(*(table.column(c)[body].as_py() for c in "abcde"))
    return table.column("unit")[body].as_py(), unit, _answered(table, WORD_COUNTS)


def _answered(table: pa.Table, which: int) -> np.ndarray:
    rows, part = np.flatnonzero(table.column("kind").to_numpy() == which), table.column("part").to_numpy()
    found = [_unpack(table.column("a")[int(r)].as_py(), 6) for r in rows[np.argsort(part[rows])]]
    return np.concatenate(found).astype(np.int64)


def _are_frequent(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return (counts >= LEAST_FREQUENT) | (keys == _END)


def _ask_pairs(parts: int):
    def run(table: pa.Table) -> pa.Table:
        number, unit, counts = _unit_of(table)
        codes, places = unit.pairs(_are_frequent(unit.keys, counts), parts)
        seen = np.bincount(places, unit.train, len(codes))
        bits = np.uint64(PAIR_BITS)
        return _rows(_requests(number, PAIRS, codes >> bits, codes & ((np.uint64(1) << bits) - np.uint64(1)), seen, PAIR_BITS // 8))

    return run


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


def _added(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Different keys of a range, their training counts, and each request's places among them."""
    asked = [np.cumsum(_unpack(x, width), dtype=np.uint64) for x in _column(table, "a")]
    counts = np.concatenate([_unpack(x, 4) for x in _column(table, "b")])
    keys, places = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.bincount(places, counts, len(keys)).astype(np.int64)
    return keys, total, np.split(places, np.cumsum([len(x) for x in asked])[:-1])


def _answers(table: pa.Table, kind: int, total: np.ndarray, places: list[np.ndarray]) -> list[tuple]:
    part = table.column("part")[0].as_py()
    return [(unit, kind, part, _pack(total[at], 6)) for unit, at in zip(_column(table, "unit"), places, strict=True)]


def _count_words(table: pa.Table) -> pa.Table:
    """Answers; and of the range, the number of tokens and kinds, of all and of the rare words."""
    keys, total, places = _added(table, 8)
    rare = ~_are_frequent(keys, total)
    totals = np.array([total.sum(), (total > 0).sum(), total[rare].sum(), (total[rare] > 0).sum()], np.int64)
    return _rows([*_answers(table, WORD_COUNTS, total, places), (-1, TOTALS, -1, totals.tobytes())])


def _count_pairs(table: pa.Table) -> pa.Table:
    _, total, places = _added(table, PAIR_BITS // 8)
    return _rows(_answers(table, PAIR_COUNTS, total, places))


def _score_unit(parts: int, tokens: int, kinds: int, rare_tokens: int, rare_kinds: int):
    scale = tokens + ADDED * (kinds + 1)

    def run(table: pa.Table) -> pa.Table:
        _, unit, counts = _unit_of(table)
        frequent = _are_frequent(unit.keys, counts)
        _, places = unit.pairs(frequent, parts)
        seen = _answered(table, PAIR_COUNTS)[places]
        share = (counts + ADDED) / scale
        rare_share = (rare_tokens + ADDED * rare_kinds + ADDED) / scale
        # training tokens of the state before each token; the start stands for one end per text
        ends = counts[np.searchsorted(unit.keys, _END)]
        at_state = np.append(ends, np.where(frequent, counts, rare_tokens)[unit.tokens][:-1])
        at_state[unit.firsts] = ends
        class_share = np.where(frequent, share, rare_share)[unit.tokens]
        within = np.where(frequent, 1.0, share / rare_share)[unit.tokens]
        failure = STRENGTH / (at_state + STRENGTH)
        arc = seen / (at_state + STRENGTH) + failure * class_share
        rows = np.repeat(np.arange(len(unit.lengths)), unit.lengths)
        per_text = lambda x: np.bincount(rows, x, len(unit.lengths))
        return pa.table({
            "doc_id": pa.array(unit.ids, pa.int64(), mask=unit.flags & 2 == 0),
            "n_tokens": pa.array(unit.lengths),
            "n_known": pa.array(per_text(counts[unit.tokens] > 0).astype(np.int64)),
            "base_score": pa.array(per_text(np.log10(share)[unit.tokens])),
            "score": pa.array(per_text(np.log10(arc * within))),
        })

    return run


def _keep(df: DataFrame, label: str) -> DataFrame:
    """As ``materialize``, for columns that are compressed already."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "none").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def score_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id, text).

    The model learns from all rows whose crc32 of doc_id mod 5 is not 1, the others are held out; rows without doc_id
    teach. Tokens are words after lower-casing A-Z and one end. base_score sums log10 of the words' smoothed shares, score
    is the automaton's log10 probability: p(c | h) = (count(h, c) + m p(c)) / (count(h) + m) over classes, a rare
    word within its class by share. Words are known by 64-bit hashes, pairs by their range and ``PAIR_BITS`` bits. NULL and empty texts are their end alone.
    Repeated rows each teach and score. An empty table gives no rows.
    """
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // RANGE
    held_out = F.coalesce(remainder == HELD_OUT, F.lit(False))
    units = _keep(rows.select("text", "doc_id", (~held_out).alias("train")).mapInArrow(_unit_batches, _ROW), "units")
    asked = units.mapInArrow(_ask_words(parts), _ROW)
    answers = _keep(asked.groupBy("part").applyInArrow(_count_words, _ROW), "word-counts")
    totals = [np.frombuffer(r.a, np.int64) for r in answers.where(F.col("kind") == TOTALS).select("a").toLocalIterator()]  # 32 bytes a range
    tokens, kinds, rare_tokens, rare_kinds = (int(x) for x in np.sum(totals, axis=0)) if totals else (0, 0, 0, 0)
    pair_parts = PAIR_RANGES * parts
    counted = units.unionByName(answers.where(F.col("kind") == WORD_COUNTS))
    pairs = counted.groupBy("unit").applyInArrow(_ask_pairs(pair_parts), _ROW).groupBy("part").applyInArrow(_count_pairs, _ROW)
    scored = counted.unionByName(pairs).groupBy("unit").applyInArrow(
        _score_unit(pair_parts, tokens, kinds, rare_tokens, rare_kinds), "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
