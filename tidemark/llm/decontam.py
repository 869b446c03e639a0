"""Benchmark passages in documents, found through templates: numbers, names and units become typed placeholders.

Windows of template tokens are hash-joined with those of the benchmark. A question whose numbers or names were
changed has the same template; its slots must then map one to one onto those of the item. A second join, on the words
themselves, finds what is copied verbatim, whatever the words are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.session import materialize

#: Tokens of a window, plain words a template window must hold, and tokens of an item that must be covered (all, if it has fewer).
WINDOW, LEAST_PLAIN, LEAST_COVERED = 8, 4, 13
#: Items of fewer tokens are found where they make up whole sentences, or the whole text.
SHORT_ITEM = 4
#: Bits of the filter that documents' windows pass before the join; its size does not depend on any table.
FILTER_BITS = 24
#: Units, as they stand after a number.
UNITS = (
    "mm cm m km g kg mg t l ml s ms min h hr hrs sec secs seconds minutes hours days weeks months years mile miles "
    "foot feet ft inch inches yard yards pound pounds lb lbs ounce ounces oz dollar dollars euro euros cent cents "
    "usd eur percent kmh mph degrees litre litres liter liters meter meters metre metres kilometers kilometres gram grams kilograms"
).split()

_KEEP = np.zeros(256, bool)
_KEEP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:"]] = True
_PLACES = np.array([0x1B873593, 0xCC9E2D51, 0x85EBCA6B], np.uint64)
NUMBER, NAME, UNIT = range(3)
_RUN_STEP, _LITERAL = 0xD6E8FEB86659FD93, 1 << 32


def _hash_words(words: list[str]) -> np.ndarray:
    raw = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return np.sort(tb.word_hashes(raw, np.append(0, ends[:-1]), ends))


_UNIT_HASHES = _hash_words(UNITS)


def template(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, template hash, slot value (0: a plain word; else its last bits tell the kind) and lower-cased word's hash of every token, and
    whether it begins a sentence.

    A token is a word without its ASCII punctuation, if anything is left. One that begins with a digit is a number; a
    unit is one only after a number; a name is capitalised, with small letters after, and neither the first word of a
    text nor of a sentence.
    """
    starts, ends, rows = tb.words(raw, offsets)
    kept = _KEEP[raw]
    places = np.concatenate(([0], np.cumsum(kept)))
    own = places[ends] > places[starts]
    first = np.concatenate(([True], np.diff(rows) > 0)) if len(rows) else np.zeros(0, bool)
    sentence = first.copy()
    sentence[1:] |= _STOP[raw[ends[:-1] - 1]]
    # a word of punctuation only hands its sentence end on
    starts, ends, rows, sentence = starts[own], ends[own], rows[own], sentence[own]
    bare = raw[kept]
    a, b = places[starts], places[ends]
    values = tb.word_hashes(tb.LOWER[bare], a, b)
    if not len(a):
        return rows, values, values, values, sentence
    digit = _DIGIT[bare[a]]
    capitals = np.concatenate(([0], np.cumsum(_UPPER[bare])))
    name = _UPPER[bare[a]] & (capitals[b] - capitals[a] == 1) & (b - a > 1) & ~sentence
    after = np.zeros(len(a), bool)
    after[1:] = digit[:-1] & (rows[1:] == rows[:-1])
    at = np.minimum(np.searchsorted(_UNIT_HASHES, values), len(_UNIT_HASHES) - 1)
    unit = after & (_UNIT_HASHES[at] == values)
    kinds = np.select([digit, unit, name], [NUMBER, UNIT, NAME], -1)
    slot = kinds >= 0
    return rows, np.where(slot, _PLACES[kinds], values), np.where(slot, values & ~np.uint64(3) | (kinds + 1).astype(np.uint64), np.uint64(0)), values, sentence


def _run_hashes(tokens: np.ndarray, width: int, seed: int) -> np.ndarray:
    n = len(tokens) - width + 1
    value = np.full(n, seed, np.uint64)
    for i in range(width):
        value = value * np.uint64(_RUN_STEP) + tokens[i : i + n]
    return value


def windows(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, place, hash and slots (windows x width) of every run of ``width`` tokens, by its words and by its template.

    By words every run counts, and has no slots; runs of fewer than ``SHORT_ITEM`` tokens only if they are whole sentences. By template a run needs enough plain words. One that begins with a name is
    given once more with that name as a plain word, as the same word is plain where it begins a text.
    """
    rows, tokens, slots, words, sentence = template(raw, offsets)
    n = len(rows) - width + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), np.zeros((0, width), np.uint64)
    firsts = np.searchsorted(rows, np.arange(len(offsets) - 1))
    whole = rows[:n] == rows[width - 1 :]
    if width < SHORT_ITEM:
        ends = np.append(sentence | np.append(True, rows[1:] != rows[:-1]), True)
        whole &= ends[:n] & ends[width : width + n]
    plain = np.concatenate(([0], np.cumsum(slots == 0)))
    plain, least = plain[width:] - plain[:n], min(LEAST_PLAIN, width)
    value = _run_hashes(tokens, width, width)
    named = value + (words[:n] - tokens[:n]) * np.uint64(pow(_RUN_STEP, width - 1, 1 << 64))
    literal, typed = np.flatnonzero(whole), np.flatnonzero(whole & (plain >= least))
    opened = np.flatnonzero(whole & (tokens[:n] == _PLACES[NAME]) & (slots[:n] > 0) & (plain + 1 >= least))
    at = np.concatenate([literal, typed, opened])
    values = np.concatenate([_run_hashes(words, width, width | _LITERAL)[literal], value[typed], named[opened]])
    own = np.lib.stride_tricks.sliding_window_view(slots, width)[at]
    own[: len(literal)] = 0
    own[len(literal) + len(typed) :, 0] = 0
    return rows[at], at - firsts[rows[at]], tb.mix(values), own


def _probe(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return (value & mask).astype(np.int64), ((value >> np.uint64(FILTER_BITS)) & mask).astype(np.int64)


def _window_batches(widths: list[int], shared=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = None if shared is None else np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little")
        for batch in batches:
            ids = batch.column(0)
            for first, _, raw, offsets in tb.pieces(batch.column(1)):
                for width in widths:
                    rows, place, value, slots = windows(raw, offsets, width)
                    if allowed is not None:
                        a, b = _probe(value)
                        hit = np.flatnonzero(allowed[a] & allowed[b])
                        rows, place, value, slots = rows[hit], place[hit], value[hit], slots[hit]
                    flat = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * width, pa.array(slots.reshape(-1).view(np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(first + rows)), pa.array(place), pa.array(value.view(np.int64)), flat], names=["id", "place", "w", "slots"]
                    )

    return run


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, raw, offsets in tb.pieces(batch.column(1)):
            rows, *_ = template(raw, offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(tb.lengths_by_row(rows, last - first))], names=["id", "n"])


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = np.unique(np.concatenate(_probe(batch.column(0).to_numpy().view(np.uint64))))
        cells, at = np.unique(places >> 6, return_inverse=True)
        bits = np.zeros(len(cells), np.uint64)
        np.bitwise_or.at(bits, at, np.uint64(1) << (places & 63).astype(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(bits.view(np.int64))], names=["cell", "bits"])


def _largest_part(found: list[dict]) -> dict[int, bool]:
    """Tokens of the runs of ``LEAST_COVERED`` or more whose windows follow one mapping of slots, and if one changed.

    Pairs of an item's and the document's value enter the mapping one by one unless they contradict it: those with equal values
    first, or those at most tokens first, whichever leaves more.
    """
    pairs = {(w["place"] + i, a, b) for w in found for i, (a, b) in enumerate(zip(w["slots"], w["own"], strict=True)) if a}
    support = Counter((a, b) for _, a, b in pairs)
    best: dict[int, bool] = {}
    for order in (lambda x: (x[0] != x[1], -support[x], x), lambda x: (-support[x], x[0] != x[1], x)):
        image: dict[int, int] = {}
        used = set()
        for a, b in sorted(support, key=order):
            if a not in image and (b & 3 == NUMBER + 1 or b not in used):
                image[a] = b
                used.add(b)
        tokens: dict[int, bool] = {}
        for w in found:
            slots = [(a, b) for a, b in zip(w["slots"], w["own"], strict=True) if a]
            if all(image.get(a) == b for a, b in slots):
                differs = any(a != b for a, b in slots)
                for token in range(w["place"], w["place"] + len(w["slots"])):
                    tokens[token] = tokens.get(token, True) and differs
        places = np.array(sorted(tokens), np.int64)
        runs = np.split(places, np.flatnonzero(np.diff(places) > 1) + 1)
        kept = {int(t): tokens[int(t)] for run in runs if len(run) >= LEAST_COVERED for t in run}
        if len(kept) > len(best):
            best = kept
    return best


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            part = _largest_part(batch.column(2)[row].as_py())
            ids = [pa.array([batch.column(i)[row].as_py()] * len(part), pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(list(part), pa.int64()), pa.array(list(part.values()), pa.bool_())], names=["doc_id", "item_id", "token", "changed"])


def _filter(found: DataFrame) -> bytes:
    """Bits of the benchmark's windows: 2 MB at any size of either table."""
    rows = found.select("w").mapInArrow(_bits, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    cells = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    cells[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return cells.tobytes()


def _texts(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("id IS NOT NULL")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, item_tokens, covered, changed): pairs of a document and a benchmark item it holds.

    covered is the number of the item's tokens in matching windows whose slots map one to one onto the document's along
    one alignment, or in windows without slots; different numbers may become the same number. Of an alignment whose slots do not, the part that follows one mapping
    counts, where it has ``LEAST_COVERED`` tokens in a row. A pair counts from ``LEAST_COVERED`` of them, or all of a shorter item. changed says that some
    slot's value differs. Items of fewer than ``WINDOW`` tokens are matched whole: verbatim, or by template if all
    their tokens are plain or at least ``LEAST_PLAIN`` are; those of fewer than ``SHORT_ITEM`` where they are whole sentences. Rows without text or id match nothing; a repeated item_id is one item with the
    longest of its texts, rows that repeat a doc_id are one document. An empty table gives no pairs.
    """
    spark = docs.sparkSession
    items = _texts(benchmark, "item_id").groupBy("id").agg(F.max_by("text", F.struct(F.length("text"), "text")).alias("text"))
    items = materialize(items, "items")
    sizes = materialize(items.mapInArrow(_token_counts, "id long, n long").where("n > 0"), "item-sizes")
    schema = "id long, place long, w long, slots array<long>"
    short = [r.n for r in sizes.where(F.col("n") < WINDOW).select("n").distinct().collect()]  # at most WINDOW - 1 widths
    wanted = None
    for width in sorted({WINDOW, *short}):
        own = sizes.where(F.col("n") >= WINDOW if width == WINDOW else F.col("n") == width)
        part = items.join(own, "id", "left_semi").mapInArrow(_window_batches([width]), schema)
        wanted = part if wanted is None else wanted.unionByName(part)
    wanted = materialize(wanted, "item-windows")
    shared = spark.sparkContext.broadcast(_filter(wanted))
    found = _texts(docs, "doc_id").mapInArrow(_window_batches(sorted({WINDOW, *short}), shared), schema)
    found = materialize(found.select(F.col("id").alias("doc_id"), F.col("place").alias("at"), "w", F.col("slots").alias("own")), "doc-windows")
    wanted = wanted.select(F.col("id").alias("item_id"), "place", "w", "slots")
    bare, open_ = F.forall("slots", lambda x: x == 0), F.forall("own", lambda x: x == 0)
    pairs = found.where(~open_).join(wanted.where(~bare), "w")
    pairs = materialize(pairs.withColumn("shift", F.col("at") - F.col("place")).drop("at").distinct(), "template-matches")
    line = ["doc_id", "item_id", "shift"]
    # a line's different pairs of slots are bounded by the item: one list tells if they map one to one and if one changed
    values = pairs.select(*line, F.explode(F.arrays_zip("slots", "own")).alias("v")).where("v.slots <> 0")
    values = values.groupBy(*line).agg(F.collect_set("v").alias("v"))
    typed = F.filter("v", lambda x: x["own"].bitwiseAND(3) != NUMBER + 1)
    forth = F.size("v") > F.size(F.array_distinct(F.col("v.slots")))
    back = F.size(typed) > F.size(F.array_distinct(F.transform(typed, lambda x: x["own"])))
    lines = materialize(values.select(*line, (forth | back).alias("odd"), F.exists("v", lambda x: x["slots"] != x["own"]).alias("changed")), "lines")
    odd, even = lines.where("odd").select(*line), lines.where("NOT odd").select(*line, "changed")
    tokens = materialize(pairs.join(even, line).select("doc_id", "item_id", "place", F.size("slots").alias("width"), "changed").distinct(), "typed")
    # windows without slots agree wherever they stand: each counts once for a document, however often it occurs
    # each step is written before the next: stages of one plan that all start at once cost the driver some MB each
    twisted = materialize(odd.select("doc_id", "item_id").distinct(), "twisted")
    same = found.where(open_).select("doc_id", "w").distinct().join(wanted.where(bare), "w")
    same = same.join(twisted, ["doc_id", "item_id"], "left_anti").select("doc_id", "item_id", "place", F.size("slots").alias("width"), F.lit(False).alias("changed"))
    same = materialize(same.distinct(), "same")
    # only where a line is not one to one they are told apart by line: there they continue its runs
    beside = wanted.where(bare).join(twisted, "item_id").join(found.where(open_), ["doc_id", "w"]).withColumn("shift", F.col("at") - F.col("place"))
    beside = materialize(beside.select(*line, "place", "slots", "own").distinct(), "beside")
    straight = beside.join(odd, line, "left_anti").select("doc_id", "item_id", "place", F.size("slots").alias("width"), F.lit(False).alias("changed"))
    tokens = materialize(tokens.unionByName(same).unionByName(straight).distinct(), "covering")
    tokens = tokens.select("doc_id", "item_id", F.explode(F.sequence(F.col("place"), F.col("place") + F.col("width") - 1)).alias("token"), "changed")
    # a line has at most a window of each kind at each place of the item, so its list is bounded by the item
    mixed = pairs.select(*line, "place", "slots", "own").unionByName(beside).join(odd, line, "left_semi")
    mixed = mixed.groupBy(*line).agg(F.collect_list(F.struct("place", "slots", "own")).alias("found"))
    parts = materialize(mixed.select("doc_id", "item_id", "found").mapInArrow(_parts, "doc_id long, item_id long, token long, changed boolean"), "parts")
    covered = tokens.unionByName(parts).groupBy("doc_id", "item_id", "token").agg(F.min("changed").alias("changed"))
    covered = covered.groupBy("doc_id", "item_id").agg(F.count("*").alias("covered"), F.max("changed").alias("changed"))
    sized = covered.join(sizes.select(F.col("id").alias("item_id"), F.col("n").alias("item_tokens")), "item_id")
    return sized.where(F.col("covered") >= F.least(F.lit(LEAST_COVERED), F.col("item_tokens"))).select("doc_id", "item_id", "item_tokens", "covered", "changed")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; rows without doc_id stay."""
    held = contaminated(docs, benchmark).select(F.col("doc_id").alias("__held")).distinct()
    held = materialize(held, "held")  # its size is known before the documents are read: where it is small they need no shuffle
    return docs.join(held, F.col("doc_id") == F.col("__held"), "left_anti")
