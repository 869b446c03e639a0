"""Toxicity by class-conditional Kneser-Ney models of words, over backoff counts that the classes share.

A word is spelt byte by byte, each byte given all before it in the word. A run longer than ``DEPTH`` bytes, as in scripts
without blanks, is spelt from each of its characters on, so the context slides over all of it. The counts are Kneser-Ney
continuation counts: how many different words a word follows. A class discounts its counts and backs off to
those of both classes together, so a rare spelling that neither class has singles out no class, and
new words that begin like known ones carry their evidence. A text's evidence is the difference of its two log-likelihoods
per word, of all words and of those that lean to label 1; a logistic curve, fitted on labelled rows that
the counts have not seen, turns it into a score.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb

#: Labelled rows of each class whose n-grams are counted, and rows the curve is fitted on, at most.
TRAIN_PER_CLASS, CALIBRATION_ROWS = 2_000, 2_000
FOLDS, HELD_OUT, CALIBRATION_FOLD = 5, 0, 4
#: Bytes of a spelling that are told apart, the discount, and the difference from which a word leans to label 1.
DEPTH, DISCOUNT, LEANING = 16, 0.75, 2.0
_START, _END = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[48:58] = np.arange(48, 58)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)


#: Characters of two and three bytes that end a word.
_MARKS = np.array([unicodedata.category(chr(c))[0] in "PZ" for c in range(1 << 16)])


def _without_marks(raw: np.ndarray) -> np.ndarray:
    """Letters and digits lower-cased, all else and non-ASCII punctuation as blanks."""
    out = _LETTERS[raw]
    for size, least, most, first in ((2, 0xC2, 0xDF, 0x1F), (3, 0xE0, 0xEF, 0x0F)):
        at = np.flatnonzero((raw >= least) & (raw <= most))
        at = at[at + size <= len(raw)]
        code = raw[at].astype(np.int64) & first
        for i in range(1, size):
            code = code << 6 | (raw[at + i] & 0x3F)
        at = at[_MARKS[code]]
        for i in range(size):
            out[at + i] = 32
    return out


def _words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts, ends and rows of every run of letters and digits, lower-cased; of a long run, from each character on."""
    raw = _without_marks(raw)
    starts, ends, rows = tb.words(raw, offsets)
    long = ends - starts > DEPTH
    if not long.any():
        return raw, starts, ends, rows
    edges = np.zeros(len(raw) + 1, np.int8)
    edges[starts[long]] += 1
    edges[ends[long]] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8) > 0
    own = np.sort(np.concatenate([starts[~long], np.flatnonzero(inside & (raw & 0xC0 != 0x80))]))
    word = np.searchsorted(starts, own, "right") - 1
    return raw, own, np.minimum(ends[word], own + DEPTH + 1), rows[word]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, hash of the word before, word), once for each piece of text."""
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for first, _, raw, offsets in tb.pieces(batch.column(0)):
            raw, starts, ends, rows = _words(raw, offsets)
            here = tb.word_hashes(raw, starts, ends)
            before = np.append(_START, here[:-1]) if len(here) else here
            if len(rows):
                before[np.flatnonzero(np.diff(rows, prepend=-1))] = _START
            label = toxic[first + rows].astype(np.uint64)
            _, once = np.unique(np.stack([label, before, here]), axis=1, return_index=True) if len(rows) else (None, rows)
            data = raw.tobytes()
            spelt = [data[a:b] for a, b in zip(starts[once], ends[once], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(label[once].astype(np.int32)), pa.array(before[once].view(np.int64)), pa.array(spelt, pa.binary())], names=["toxic", "h", "w"]
            )


@dataclass
class Model:
    """Log-likelihood difference, toxic minus ordinary, by hash of a spelling's beginning."""

    nodes: np.ndarray
    here: np.ndarray
    beyond: np.ndarray
    curve: tuple[float, ...] = ()

    def tables(self) -> tuple:
        """What a broadcast carries: plain arrays, so tasks need no copy of this class."""
        return self.nodes, self.here, self.beyond, self.curve

    def _look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.nodes):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.nodes, keys), len(self.nodes) - 1)
        return at, self.nodes[at] == keys

    def differences(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of each word: that of the whole word if known, else that beyond its longest known beginning."""
        keys = tb.word_hashes(raw, starts, ends)
        kinds, first, back = np.unique(keys, return_index=True, return_inverse=True)
        starts, ends = starts[first], ends[first]
        at, hit = self._look(kinds ^ _END)
        found = np.zeros(len(kinds))
        found[hit] = self.here[at[hit]]
        open_ = np.flatnonzero(~hit)
        for depth in range(1, DEPTH + 1):
            open_ = open_[ends[open_] - starts[open_] >= depth]
            if not len(open_):
                break
            at, hit = self._look(tb.word_hashes(raw, starts[open_], starts[open_] + depth))
            open_ = open_[hit]
            found[open_] = self.beyond[at[hit]]
        return found[back]

    def evidence(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, 3): words, summed difference, and what differences over ``LEANING`` have above it."""
        n = len(offsets) - 1
        raw, starts, ends, rows = _words(raw, offsets)
        if not len(rows):
            return np.zeros((n, 3))
        r = self.differences(raw, starts, ends)
        return np.stack([np.bincount(rows, minlength=n), np.bincount(rows, r, n), np.bincount(rows, np.maximum(r - LEANING, 0), n)], axis=1)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_features(evidence) @ np.array(self.curve), -30, 30)))


def _features(evidence: np.ndarray) -> np.ndarray:
    """Constant, and per word: the difference, that of leaning words, and its rise over few words."""
    n = np.maximum(evidence[:, 0], 1)
    leaning = evidence[:, 2] / n
    return np.stack([np.ones(len(n)), 5 * evidence[:, 1] / n, np.log1p(200 * leaning), np.log1p(evidence[:, 2])], axis=1)


def fit_counts(toxic: np.ndarray, spelt: list[bytes], n: np.ndarray) -> Model:
    """Kneser-Ney tables over the beginnings of words, from continuation counts of both classes."""
    if not spelt:
        return Model(np.zeros(0, np.uint64), np.zeros(0, np.float32), np.zeros(0, np.float32))
    raw = np.frombuffer(b"".join(spelt), np.uint8)
    sizes = np.array([len(w) for w in spelt], np.int64)
    starts = np.cumsum(sizes) - sizes
    counts = np.stack([np.where(toxic == label, n, 0) for label in (0, 1)]).astype(float)
    parent, parents = np.zeros(len(spelt), np.int64), 1
    level = {"n": counts.sum(axis=1, keepdims=True), "r": np.zeros(1)}
    keys, here, beyond = [], [], []
    alive = np.arange(len(spelt))
    for depth in range(1, DEPTH + 2):
        over = sizes[alive] < depth
        reach = np.minimum(starts[alive] + depth, starts[alive] + sizes[alive])
        key = tb.word_hashes(raw, starts[alive], reach)
        key = np.where(over, key ^ _END, key)
        nodes, first, node = np.unique(key, return_index=True, return_inverse=True)
        up = parent[alive][first]
        own = np.stack([np.bincount(node, counts[c][alive], len(nodes)) for c in (0, 1)])
        kinds = np.stack([np.bincount(up[own[c] > 0], minlength=parents) for c in (0, 1)]).astype(float)
        both, above = own.sum(axis=0), level["n"]
        all_kinds, all_above = np.bincount(up, minlength=parents).astype(float), above.sum(axis=0)
        shared = (np.maximum(both - DISCOUNT, 0) + DISCOUNT * all_kinds[up] / 257) / all_above[up]
        split = (above > 0).all(axis=0)
        p = (np.maximum(own - DISCOUNT, 0) + DISCOUNT * kinds[:, up] * shared) / np.maximum(above[:, up], 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            r = level["r"][up] + np.where(split[up], np.log(p[1]) - np.log(p[0]), 0.0)
            leave = np.log(kinds[1] / above[1]) - np.log(kinds[0] / above[0])
        if depth > 1:
            beyond[-1][:] = level["r"] + np.where(split & (kinds > 0).all(axis=0), leave, 0.0)
        keys.append(nodes)
        here.append(r)
        beyond.append(r.copy())
        level, parents = {"n": own, "r": r}, len(nodes)
        parent[alive] = node
        # below a beginning that one class alone has, or that was seen once, nothing more is learnt
        alive = alive[~over & (both[node] > 1) & (own[:, node] > 0).all(axis=0)]
        if not len(alive):
            break
    nodes = np.concatenate(keys)
    order = np.argsort(nodes)
    take = lambda x: np.concatenate(x)[order].astype(np.float32)
    return Model(nodes[order], take(here), take(beyond))


def _fit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, spelt, n = [np.zeros(0, np.int32)], [], [np.zeros(0, np.int64)]
    for batch in batches:
        toxic.append(batch.column(0).to_numpy())
        spelt += batch.column(1).to_pylist()
        n.append(batch.column(2).to_numpy())
    model = fit_counts(np.concatenate(toxic), spelt, np.concatenate(n))
    tables = [pa.array([x.tobytes()], pa.binary()) for x in (model.nodes, model.here, model.beyond)]
    yield pa.RecordBatch.from_arrays(tables, names=["nodes", "here", "beyond"])


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Newton steps for a logistic curve with a small quadratic penalty."""
    b, penalty = np.zeros(x.shape[1]), np.diag([1e-3] + [1e-2] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ b)
        b = b - step
        if np.abs(step).max() < 1e-10:
            break
    return tuple(b)


def _scorer(shared, with_score: bool):
    """The text column replaced by its score, or by its evidence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            found = np.concatenate([np.zeros((0, 3)), *(model.evidence(raw, offsets) for _, _, raw, offsets in tb.pieces(batch.column(0)))])
            columns = [batch.column(i) for i in range(1, batch.num_columns)]
            added = [pa.array(model.score(found))] if with_score else [pa.array(np.ascontiguousarray(found[:, i])) for i in range(3)]
            names = [*batch.schema.names[1:], *(["__score"] if with_score else ["n", "all", "leaning"])]
            yield pa.RecordBatch.from_arrays([*columns, *added], names=names)

    return run


def fold() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Counts from folds 1 to 3 and the curve from fold 4 of the labelled rows, fold 0 left out.

    At most ``TRAIN_PER_CLASS`` rows of each class and ``CALIBRATION_ROWS`` others are read, those with the least
    hash of doc_id. Rows without doc_id, label or text teach nothing; a doc_id labelled twice
    counts once as toxic if any of its labels says so. Without rows of both classes every score is 0.5 or the share.
    """
    spark = docs.sparkSession
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("fold", fold()).where(F.col("fold") != HELD_OUT)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def sample(rows: DataFrame, n: int) -> DataFrame:
        return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)

    counted = marks.where(F.col("fold") != CALIBRATION_FOLD)
    chosen = sample(counted.where("toxic = 1"), TRAIN_PER_CLASS).unionByName(sample(counted.where("toxic = 0"), TRAIN_PER_CLASS))
    grams = texts.join(chosen.select("doc_id", "toxic"), "doc_id").select("text", "toxic").mapInArrow(_count_batches, "toxic int, h long, w binary").distinct()
    # one task fits the tables: it gets the different words of the two samples at most, whatever the tables hold
    fitted = grams.groupBy("toxic", "w").agg(F.count("*").alias("n")).repartition(1).sortWithinPartitions("toxic", "w")
    tables = fitted.mapInArrow(_fit_batches, "nodes binary, here binary, beyond binary").first()
    model = Model(*(np.frombuffer(x, t) for x, t in zip(tables or (b"",) * 3, (np.uint64, np.float32, np.float32), strict=True)))

    rest = sample(marks.where(F.col("fold") == CALIBRATION_FOLD), CALIBRATION_ROWS)
    shared = spark.sparkContext.broadcast(model.tables())
    seen = texts.join(rest.select("doc_id", "toxic"), "doc_id").select("text", "doc_id", "toxic")
    rows = seen.mapInArrow(_scorer(shared, False), "doc_id long, toxic int, n double, all double, leaning double").orderBy("doc_id").toArrow()
    x = _features(np.stack([rows.column(c).to_numpy() for c in ("n", "all", "leaning")], axis=1))
    model.curve = _logistic(x, rows.column("toxic").to_numpy().astype(float)) if len(x) else (0.0,) * x.shape[1]
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    Score is the probability of label 1 from the text alone; NULL and empty texts get the curve's value for no
    evidence. predicted is 1 from 0.5. held_out marks rows whose crc32 of doc_id mod 5 is 0, which
    teach nothing (false without doc_id). Every row is scored, repeated rows alike; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels).tables())
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    scored = rows.mapInArrow(_scorer(shared, True), "doc_id long, __score double").withColumnRenamed("__score", "score")
    return scored.select("doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score under 0.5, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels).tables())
    kept = f"__text_{len(docs.columns)}"
    rows = docs.select(F.col("text").cast("string").alias(kept), "*")
    scored = rows.mapInArrow(_scorer(shared, True), docs.withColumn("__score", F.lit(0.0)).schema)
    return scored.where("__score < 0.5").select(*docs.columns)
