"""Secrets in texts: three fixed patterns, and random-looking strings by two character Markov models.

The models are of the same order: one of random strings, one of ordinary identifiers. A candidate
is a run of key characters with letters and digits; it is a secret if the log-likelihood ratio is high enough.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb

#: The base kinds, in the order in which kinds are listed, with the least length of the part in brackets.
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": re.compile(
        r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    ),
    "access": re.compile(r"(AKIA[A-Z0-9]+)"),
    "hex": re.compile(r"([0-9a-f]+)"),
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
RANDOM = "markov"

#: Candidates of the models, and the ratio that marks a secret: natural logs, in all and per character.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LEAST_RATIO, LEAST_PER_CHARACTER = 40.0, 2.0
#: Lengths of ordinary identifiers; seeded random strings made for each alphabet.
IDENTIFIER, TRAIN_STRINGS, SEED = (4, 64), 2_000, 20_240_229
ALPHABETS = (
    "0123456789abcdef",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
)
_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_N = len(_SYMBOLS) + 1
_INDEX = np.full(256, 0, np.int64)
_INDEX[[ord(c) for c in _SYMBOLS]] = np.arange(1, _N)

_KEY = np.zeros(256, bool)
_KEY[[ord(c) for c in _SYMBOLS]] = True
_DIGIT, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_DIGIT[48:58] = _LETTER[65:91] = _LETTER[97:123] = True
_ASSIGN = np.zeros(256, bool)
_ASSIGN[[ord(":"), ord("=")]] = True


def transitions(strings: list[str]) -> np.ndarray:
    """Log-probabilities of a character after the one before it (0: start), smoothed towards the characters' shares."""
    counts = np.zeros((_N, _N))
    for s in strings:
        symbols = np.concatenate(([0], _INDEX[np.frombuffer(s.encode(), np.uint8)]))
        np.add.at(counts, (symbols[:-1], symbols[1:]), 1)
    shares = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * _N)
    return np.log((counts + 10 * shares) / (counts.sum(axis=1, keepdims=True) + 10))


def random_strings() -> dict[str, list[str]]:
    """The labelled random samples: strings of 20 to 64 characters over each alphabet."""
    rng = np.random.default_rng(SEED)
    return {
        a: ["".join(rng.choice(list(a), rng.integers(20, 65))) for _ in range(TRAIN_STRINGS)] for a in ALPHABETS
    }


def log_ratio(text: str, tables: tuple[np.ndarray, np.ndarray]) -> float:
    symbols = np.concatenate(([0], _INDEX[np.frombuffer(text.encode(), np.uint8)]))
    random, ordinary = (t[..., symbols[:-1], symbols[1:]].sum(axis=-1) for t in tables)
    return float(random.max() - ordinary)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) in code points, in order."""
    found = []
    for number, kind in enumerate(KINDS):
        for m in PATTERNS[kind].finditer(text):
            if m.end(1) - m.start(1) >= LEAST[kind]:
                found.append((m.start(), number, m.end()))
    return sorted(found)


def _is_candidate(part: str) -> bool:
    return bool(CANDIDATE.fullmatch(part) and re.search("[0-9]", part) and re.search("[A-Za-z]", part))


def model_spans(text: str, base: list[tuple[int, int, int]], tables) -> list[tuple[int, int, int]]:
    """Random-looking candidates that no base span touches; ``base`` is in order."""
    found = []
    starts = [a for a, _, _ in base]
    reach = list(itertools.accumulate((b for _, _, b in base), max))  # the furthest end so far
    for m in CANDIDATE.finditer(text):
        part = m[0]
        before = bisect.bisect_left(starts, m.end())
        if not _is_candidate(part) or before and reach[before - 1] > m.start():
            continue
        ratio = log_ratio(part, tables)
        if ratio >= LEAST_RATIO and ratio >= LEAST_PER_CHARACTER * len(part):
            found.append((m.start(), len(KINDS), m.end()))
    return found


def _suspects(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that may hold any span: one with an assignment sign, or a run of 20 key characters."""
    marks = np.flatnonzero(_ASSIGN[raw])
    solid = np.concatenate(([False], _KEY[raw], [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    long_ = edges[::2][edges[1::2] - edges[::2] >= 20]
    places = np.concatenate((marks, long_))
    # a run may begin in one text and end in the next: both are looked at
    rows = np.searchsorted(offsets, places, "right") - 1
    ends = np.searchsorted(offsets, edges[1::2][edges[1::2] - edges[::2] >= 20] - 1, "right") - 1
    crossing = [np.arange(a, b + 1) for a, b in zip(rows[len(marks) :], ends, strict=True) if b > a]
    return np.unique(np.concatenate([rows, *crossing]))


def _spans_of(batch: pa.RecordBatch, tables) -> list[list[tuple[int, int, int]]]:
    spans: list[list[tuple[int, int, int]]] = [[] for _ in range(batch.num_rows)]
    texts = batch.column(0)
    for first, _, raw, offsets in tb.pieces(texts):
        for row in _suspects(raw, offsets):
            text = raw[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8", "replace")
            base = base_spans(text)
            spans[first + row] = sorted(base + model_spans(text, base, tables))
    return spans


def _scanner(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
        for batch in batches:
            spans = [[{"start": a, "kind": k, "end": b} for a, k, b in row] for row in _spans_of(batch, shared.value)]
            columns = [batch.column(i) for i in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], names=[*batch.schema.names[1:], "spans"])

    return run


def _redactor(shared, where: int, mask: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(0), _spans_of(batch, shared.value)
            if any(found):
                cleaned = texts.to_pylist()
                for row, spans in enumerate(found):
                    if spans:
                        cleaned[row] = _masked(cleaned[row], spans, mask)
                texts = pa.array(cleaned, batch.column(0).type)
            columns = [batch.column(i) for i in range(1, batch.num_columns)]
            columns[where] = texts
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[1:])

    return run


def _masked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """Overlapping spans become one mask."""
    parts, at, end = [], 0, -1
    for a, _, b in spans:
        if a >= end:
            parts += [text[max(at, 0) : a], mask]
        end = max(end, b)
        at = end
    return "".join(parts) + text[at:]


def identifier_pairs(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often a key character follows another (0: start) in the ordinary identifiers of the texts.

    These are the runs of key characters with a length in ``IDENTIFIER``, each once a text, without candidates and without runs that a base span touches.
    """
    solid = np.concatenate((_KEY[raw], [False]))
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid[:-1] & (np.concatenate(([True], ~solid[:-2])) | edge[:-1])) if len(raw) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros((_N, _N), np.int64)
    ends = np.flatnonzero(solid[:-1] & (~solid[1:] | edge[1:])) + 1
    covered = np.zeros(len(raw) + 1, bool)
    for row in _suspects(raw, offsets):
        part = raw[offsets[row] : offsets[row + 1]]
        where = np.append(np.flatnonzero((part & 0xC0) != 0x80), len(part)) + offsets[row]  # bytes of the code points
        for a, _, b in base_spans(part.tobytes().decode("utf-8", "replace")):
            covered[where[a] : where[b]] = True
    sizes = ends - starts
    hit, digits, letters = (np.diff(np.concatenate(([0], np.cumsum(x)))[np.stack((starts, ends))], axis=0)[0] for x in (covered[:-1], _DIGIT[raw], _LETTER[raw]))
    kept = (sizes >= IDENTIFIER[0]) & (sizes <= IDENTIFIER[1]) & (hit == 0) & ~((sizes >= 20) & (digits > 0) & (letters > 0))
    starts, ends = starts[kept], ends[kept]
    rows = np.searchsorted(offsets, starts, "right") - 1
    _, once = np.unique(tb.word_hashes(raw, starts, ends) ^ tb.mix(rows.astype(np.uint64) + np.uint64(1)), return_index=True)
    starts, sizes = starts[once], (ends - starts)[once]
    first = np.cumsum(sizes) - sizes
    symbols = _INDEX[raw[np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))]]
    before = np.append(0, symbols[:-1])
    before[first] = 0
    return np.bincount(before * _N + symbols, minlength=_N * _N).reshape(_N, _N)


def train(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Transition tables: of random strings by alphabet, and of the ordinary identifiers of all documents.

    Texts are read in tasks; the driver gets counts of character pairs, at most 68 x 68.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((_N, _N), np.int64)
        for batch in batches:
            for _, _, raw, offsets in tb.pieces(batch.column(0)):
                counts += identifier_pairs(raw, offsets)
        a, b = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(counts[a, b])], names=["a", "b", "n"])

    seen = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(pairs, "a long, b long, n long")
    counts = np.zeros((_N, _N))
    for a, b, n in seen.groupBy("a", "b").agg(F.sum("n")).collect():
        counts[a, b] = n
    shares = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * _N)
    ordinary = np.log((counts + 10 * shares) / (counts.sum(axis=1, keepdims=True) + 10))
    return np.stack([transitions(s) for s in random_strings().values()]), ordinary


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for every row of ``docs`` (doc_id, text); spans: array of (start, kind, end) in order.

    Offsets are code points, end exclusive; kind is the place in ``KINDS``, or the next number for the models.
    Whole texts are scanned; NULL is empty and has no span. Rows that repeat and rows without doc_id are scanned alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    return rows.mapInArrow(_scanner(shared), "doc_id long, spans array<struct<start:long,kind:int,end:long>>")


def secret_spans(docs: DataFrame) -> DataFrame:
    """``scan`` as digests: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov."""
    names = F.array(*(F.lit(k) for k in (*KINDS, RANDOM)))

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    return scan(docs).select(
        "doc_id", *(number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), number(len(KINDS)).alias(f"n_{RANDOM}"),
    )


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its text masked; n_chars, if there, follows. Other columns and all rows stay."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))
    own = f"__text_{len(docs.columns)}"
    where = [c.lower() for c in docs.columns].index("text")
    cleaned = docs.select(F.col("text").cast("string").alias(own), "*").mapInArrow(_redactor(shared, where, mask), docs.schema)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.instr("text", mask) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cleaned
