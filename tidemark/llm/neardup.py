"""Near-duplicate groups by fast similarity sketches, banding and exact verification.

A sketch has ``SIZE`` coordinates. In each of the first ``SIZE`` rounds every shingle is hashed to a
bin and a value; a bin keeps the smallest value of the first round that reaches it. Another ``SIZE``
rounds give every shingle to the one bin of the round, so all coordinates fill for any set. A text
usually needs a few rounds: their number falls with the size of its set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.llm.components import components
from tidemark.session import discard, materialize

SIZE, BANDS = 128, 32
WIDTH = 5
NUMERATOR, DENOMINATOR = 75, 100
#: Pairs whose sketches agree in fewer coordinates are not verified: 5 standard deviations under 0.75.
LEAST_AGREEMENT = int(SIZE * 0.55)
STAR_ROUNDS = 1
BLOCK = 512
#: Most ids (8 bytes each) that go to every task to leave texts out where they are read; beyond, all texts are joined.
SENT_IDS = 1_000_000
_SEEDS = tb.mix(np.arange(1, 2 * SIZE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words has them all as one shingle."""
    raw = tb.LOWER[raw]
    starts, ends, rows = tb.words(raw, offsets)
    hashes = tb.word_hashes(raw, starts, ends)
    counts = tb.lengths_by_row(rows, len(offsets) - 1)
    firsts = np.concatenate(([0], np.cumsum(counts)))
    step, total = np.uint64(0xD6E8FEB86659FD93), max(len(hashes) - width + 1, 0)
    rolled = np.zeros(total, np.uint64)
    for i in range(width):
        rolled = rolled * step + hashes[i : i + total]
    rolled = tb.mix(rolled)
    sets = []
    for row, n in enumerate(counts):
        a = firsts[row]
        if n >= width:
            sets.append(np.unique(rolled[a : a + n - width + 1]))
        elif n:
            one = np.array([n], np.uint64)
            for k in range(a, a + n):
                one = one * step + hashes[k]
            sets.append(tb.mix(one))
        else:
            sets.append(hashes[:0])
    return sets


def sketches(sets: list[np.ndarray], size: int = SIZE) -> np.ndarray:
    """(texts, size) array of 16-bit coordinates; equal coordinates mean the same least shingle."""
    n = len(sets)
    best = np.full(n * size, _NONE, np.uint64)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    items = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    for step in range(2 * size):
        if not len(items):
            break
        value = tb.mix(items ^ _SEEDS[step])
        bins = (value & np.uint64(size - 1)).astype(np.int64) if step < size else step - size
        slots = rows * size + bins
        free = best[slots] == _NONE
        np.minimum.at(best, slots[free], value[free] >> np.uint64(7))
        full = (best.reshape(n, size) != _NONE).all(axis=1)
        open_rows = ~full[rows]
        items, rows = items[open_rows], rows[open_rows]
    return (tb.mix(best) & np.uint64(0xFFFF)).astype(np.uint16).reshape(n, size)


def _sums(sets: list[np.ndarray], seed: int) -> np.ndarray:
    return np.array([tb.mix(s ^ np.uint64(seed)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, raw, offsets in tb.pieces(batch.column(1)):
            sets = shingle_sets(raw, offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(_sums(sets, 0x5851F42D4C957F2D)),
                    pa.array(_sums(sets, 0x14057B7EF767814F)),
                    pa.array([s.tobytes() for s in sketches(sets)], pa.binary()),
                ],
                names=["doc_id", "n", "d1", "d2", "sketch"],
            )


def _agreement_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = (
            np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, SIZE) for i in (2, 3)
        )
        close = (left == right).sum(axis=1) >= LEAST_AGREEMENT
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(close)) for i in (0, 1)], names=["a", "b"])


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by centre and salt, the centre's own text first."""
    centre, own = None, []
    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
        a, b = [], []
        for first, last, raw, offsets in tb.pieces(batch.column(4)):
            for (c, salt, role, doc), found in zip(keys[first:last], shingle_sets(raw, offsets), strict=True):
                if (c, salt) != centre:
                    centre, own = (c, salt), []
                if role == 0:
                    own.append(found)
                    continue
                for mine in own:
                    shared = len(np.intersect1d(mine, found, assume_unique=True))
                    if shared and DENOMINATOR * shared >= NUMERATOR * (len(mine) + len(found) - shared):
                        a.append(c)
                        b.append(doc)
                        break
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _close_pairs(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of one block of a bucket, or of two, each with the rows whose sketches agree with it, best first.

    Only rows of different labels pair, and a pair is looked at in the first band that both share only.
    """
    side = table.column("side").to_numpy()
    ids, labels = (table.column(c).to_numpy() for c in ("rep", "label"))
    marks = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(-1, SIZE)
    bands = marks.reshape(len(marks), BANDS, -1)
    band, alone = table.column("band")[0].as_py(), table.column("i")[0] == table.column("j")[0]
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if alone else 1))
    for k in left:
        agree = (marks[right] == marks[k]).sum(axis=1)
        order = np.argsort(-agree, kind="stable")
        hits = right[order[agree[order] >= LEAST_AGREEMENT]]
        hits = hits[(labels[hits] != labels[k]) & (ids[hits] > ids[k] if alone else ids[hits] != ids[k])]
        yield k, hits[(bands[hits] == bands[k]).all(axis=2).argmax(axis=1) == band]


def _close_rows(table: pa.Table) -> pa.Table:
    """The rows that pair with another by sketch: only their texts are needed."""
    paired = np.zeros(len(table), bool)
    for k, hits in _close_pairs(table):
        paired[hits] = True
        paired[k] |= len(hits) > 0
    return table.filter(pa.array(paired))


def _link_block(table: pa.Table) -> pa.Table:
    """Links between different components within one block of a bucket, or between two blocks.

    Labels that a link joins are one from then on.
    """
    ids, labels = (table.column(c).to_numpy() for c in ("rep", "label"))
    texts, sets, joined, a, b = table.column("text"), {}, {}, [], []

    def found(k):
        if k not in sets:
            ((_, _, raw, offsets),) = tb.pieces(texts.slice(k, 1))
            sets[k] = shingle_sets(raw, offsets)[0]
        return sets[k]

    def root(label):
        while label in joined:
            label = joined[label]
        return label

    for k, hits in _close_pairs(table):
        for other in hits:
            x, y = root(labels[k]), root(labels[other])
            if x == y:
                continue
            mine, theirs = found(k), found(other)
            shared = len(np.intersect1d(mine, theirs, assume_unique=True))
            if DENOMINATOR * shared >= NUMERATOR * (len(mine) + len(theirs) - shared):
                joined[x] = y
                a.append(ids[k])
                b.append(ids[other])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _few(ids: DataFrame) -> bool:
    return ids.count() <= SENT_IDS


class _Groups:
    """The tables of one search: sketches of the distinct sets, texts, links found so far."""

    def __init__(self, docs: DataFrame):
        self.spark = docs.sparkSession
        self.texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
        raw = self.texts.mapInArrow(_sketch_batches, "doc_id long, n long, d1 long, d2 long, sketch binary")
        sketched = raw.groupBy("doc_id").agg(F.min(F.struct("n", "d1", "d2", "sketch")).alias("s"), F.count("*").alias("rows"))
        self.docs = materialize(sketched.select("doc_id", "s.*", "rows"), "sketches")
        classes = self.docs.where("n > 0").groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "sketch")).alias("m"))
        self.classes = materialize(classes.select("d1", "d2", F.col("m.doc_id").alias("rep"), "m.sketch"), "reps")
        self.reps = self.classes.select("rep", "sketch")

    def texts_of(self, ids: DataFrame) -> DataFrame:
        """The texts, without those of other documents if ``ids`` (doc_id) are counted to be few."""
        wanted = materialize(ids.distinct(), "wanted")
        return self.texts.join(F.broadcast(wanted), "doc_id", "left_semi") if _few(wanted) else self.texts

    def members(self) -> DataFrame:
        """(key, rep) of the band buckets with two or more sets."""
        per = SIZE // BANDS * 2
        bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("sketch", b * per + 1, F.lit(per))))
        rows = self.reps.select("rep", F.posexplode(bands).alias("band", "key")).repartition("key")
        shared = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
        return materialize(rows.join(shared, "key", "left_semi").select("key", "band", "rep"), "buckets")

    def verified(self, edges: DataFrame, label: str) -> DataFrame:
        """The pairs (a, b) that are links, by the full sets of both texts."""
        close = edges
        for end in ("a", "b"):
            close = close.join(self.reps.select(F.col("rep").alias(end), F.col("sketch").alias(f"{end}_sketch")), end)
        close = materialize(
            close.select("a", "b", "a_sketch", "b_sketch").mapInArrow(_agreement_filter, "a long, b long"), f"{label}-close"
        )
        total = close.count()
        if not total:
            return close
        salts = 16 + total // 50_000
        rows = close.select(F.col("a").alias("centre"), F.pmod(F.xxhash64("b"), F.lit(salts)).alias("salt"), F.col("b").alias("doc_id"))
        firsts = rows.select("centre", "salt").distinct()
        ends = close.select(F.explode(F.array("a", "b")).alias("doc_id"))
        rows = rows.withColumn("role", F.lit(1)).unionByName(firsts.withColumn("role", F.lit(0)).withColumn("doc_id", F.col("centre")))
        return materialize(
            rows.join(self.texts_of(ends), "doc_id").select("centre", "salt", "role", "doc_id", "text")
            .repartition("centre", "salt").sortWithinPartitions("centre", "salt", "role")
            .mapInArrow(_verify_batches, "a long, b long"),
            label,
        )

    def mixed(self, members: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Members of the buckets that still hold several components, with their labels."""
        if labels is None:
            return members.withColumn("label", F.col("rep"))
        known = members.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left").select("key", "band", "rep", F.coalesce("label", "rep").alias("label"))
        split = known.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("key")
        return known.join(split, "key", "left_semi")

    def stars(self, mixed: DataFrame, turn: int) -> DataFrame:
        """Each member with its bucket's centre, as often as they share one: the least member first, then members picked by hash."""
        order = F.col("rep") if turn == 0 else F.xxhash64("rep", F.lit(turn))
        centres = mixed.groupBy("key").agg(F.min(F.struct(order.alias("o"), F.col("rep").alias("c"), F.col("label").alias("l"))).alias("m")).select("key", "m.c", "m.l")
        rows = mixed.join(centres, "key").where("label <> l")
        return rows.select(F.col("c").alias("a"), F.col("rep").alias("b"))

    def rest(self, mixed: DataFrame) -> DataFrame:
        """Links between the components of a bucket, in blocks of bounded size.

        Sketches tell first which rows of a block pair at all; only these come again with their texts, which verify the pairs.
        """
        sizes = mixed.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        rows = mixed.join(sizes, "key").join(self.reps, "rep").withColumn("own", F.pmod(F.xxhash64("rep", F.lit(7)), F.col("blocks")).cast("int"))
        others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        rows = rows.select("key", "band", "rep", "label", "sketch", "own", others.alias("other"))
        rows = rows.select(
            "key", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "rep", "label", "sketch",
        )
        close = rows.groupBy("key", "i", "j").applyInArrow(_close_rows, "key long, band int, i int, j int, side int, rep long, label long, sketch binary")
        close = materialize(close, "close-rows")
        found = self.texts_of(close.select(F.col("rep").alias("doc_id")))
        texts = close.join(found.withColumnRenamed("doc_id", "rep"), "rep").select(*close.columns, "text")
        return texts.groupBy("key", "i", "j").applyInArrow(_link_block, "a long, b long")


def _merged(labels: DataFrame | None, links: DataFrame, turn: int) -> DataFrame:
    """(node, label) after more links: they join the components there are, which are then few nodes."""
    if labels is not None:
        for end in ("a", "b"):
            named = labels.select(F.col("node").alias(end), "label")
            links = links.join(named, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    joined = components(links)
    if labels is not None:
        further = joined.select(F.col("node").alias("label"), F.col("label").alias("lowest"))
        moved = labels.join(further, "label", "left").select("node", F.coalesce("lowest", "label").alias("label"))
        joined = moved.unionByName(joined.join(moved.select("node"), "node", "left_anti"))
    return materialize(joined, f"labels{turn}")


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The table of sketches, with how many rows bear a doc_id, and the result for documents that have one."""
    work = _Groups(docs)
    members = work.members()
    tested, labels = None, None
    for turn in range(STAR_ROUNDS + 1):
        mixed = work.mixed(members, labels)
        if labels is not None:
            mixed = materialize(mixed, f"mixed{turn}")
        if not mixed.take(1):
            break
        if turn == STAR_ROUNDS:
            links = materialize(work.rest(mixed), "rest")
        else:
            pairs = work.stars(mixed, turn).select("a", "b", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
            if tested is not None:
                pairs = pairs.join(tested, ["lo", "hi"], "left_anti")
            pairs = materialize(pairs.dropDuplicates(["lo", "hi"]), f"pairs{turn}")
            links = work.verified(pairs.select("a", "b"), f"links{turn}")
            pairs = pairs.select("lo", "hi")
            tested = pairs if tested is None else tested.union(pairs)
        if labels is not None:
            discard(mixed)
        if links.take(1):
            labels = _merged(labels, links, turn)
    discard(members)
    copies = work.classes.select("d1", "d2", "rep")
    own = work.docs.join(copies, ["d1", "d2"], "left").select("doc_id", "n", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("doc_id")).alias("rep"))
    if labels is not None:
        own = own.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left").withColumn("rep", F.coalesce("label", "rep"))
    return work.docs, own.select("doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("component_id"), (F.col("doc_id") == F.col("rep")).alias("kept"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every document of ``docs`` (doc_id, text).

    Sets are the distinct shingles of ``WIDTH`` words after lower-casing A-Z; a text with fewer words is
    one shingle, one without words (or NULL) has none and no link. Documents are linked if
    the shared part of their sets is 0.75 of the union or more, confirmed on the full sets. component_id
    is the smallest doc_id reachable over links, kept marks the document that bears it. Shingles are 64-bit hashes.

    Equal sets are one class before anything else, so copies meet only in sums. Buckets of a band are first
    compared with one centre each, ``STAR_ROUNDS`` times; a bucket whose members are connected is done. Members
    of different components in one bucket are then compared by sketch in blocks and verified, so no link
    between sets that share a bucket is lost. Two sets at 0.75 miss all 32 bands with probability 5e-6.

    Rows that repeat a doc_id count as one document. Rows without doc_id are kept, with a NULL
    component. An empty table gives an empty result; other columns are ignored.
    """
    _, result = _grouped(docs)
    loose = docs.where("doc_id IS NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    loose = loose.mapInArrow(_sketch_batches, "doc_id long, n long, d1 long, d2 long, sketch binary")
    return result.unionByName(loose.select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is kept, with all their columns.

    Of rows that repeat a doc_id one stays; rows without doc_id all stay.
    """
    sketched, result = _grouped(docs.select("doc_id", "text"))
    copies = materialize(result.where("NOT kept").select(F.col("doc_id").alias("__copy")), "copies")
    rows = docs.join(F.broadcast(copies) if _few(copies) else copies, F.col("doc_id") == F.col("__copy"), "left_anti")
    if not sketched.where("rows > 1").take(1):
        return rows
    return rows.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(rows.where("doc_id IS NULL"))
