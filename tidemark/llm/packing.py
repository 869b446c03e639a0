"""Documents packed into sequences of a fixed number of tokens, by a configuration linear program.

Documents become ids; those longer than a sequence are cut into pieces. Only the histogram of piece lengths leaves
the tasks, at most ``SEQUENCE`` numbers. Over it a linear program is solved: a variable for each configuration (a
multiset of lengths that fit one sequence), a covering constraint for each length. Multiplicative weights set the price of
each length, a knapsack dynamic program finds configurations of the greatest price, and the fractional solution is
rounded to whole numbers of sequences. Pieces then take numbered places: each piece's number within its length
follows from counts, so the assignment is arithmetic on every row and nothing is gathered.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.session import materialize

SEQUENCE = 2048
END_ID = 0
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Rounds of multiplicative weights, how far from the best price a configuration may be, and the learning rate.
ROUNDS, SLACK, RATE = 60, 0.05, 0.5
#: Spans whose ids a Python worker remembers; others are encoded again, which changes no result.
REMEMBERED = 200_000

_PIECES = "doc_id long, piece int, start long, length long, ids array<int>, ids_crc32 long, unit long, number long"


_APOSTROPHE, _LESS, _BAR = b"'<|"
_LETTER, _DIGIT, _SIGN = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_DIGIT[48:58] = True
_SIGN[33:127] = ~_LETTER[33:127] & ~_DIGIT[33:127]
_SIGN[_APOSTROPHE] = False


class Encoder:
    """Ids of spans of text. A Python worker remembers them by the spans' hashes: between ``limit`` used lately and twice as many.

    The vocabulary drops white space and never looks across it, so spans can be encoded apart. Plain spans are single words to it,
    already in lower case: they skip its normalizer and are encoded together, as the last token of a word says so.
    """

    def __init__(self, path: str, limit: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.limit, self.turn = Tokenizer.from_file(path), limit, 0
        self.single = Tokenizer(self.whole.model)
        self.single.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary, suffix = self.whole.get_vocab(with_added_tokens=True), self.whole.model.end_of_word_suffix
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[k for token, k in vocabulary.items() if token.endswith(suffix)]] = True
        # Of each span remembered, in the order of the hashes: where its ids begin, how many there are, and when it was used last.
        self.hashes, self.begin = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.count, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.array([END_ID], np.int32)  # END_ID, then the ids of all spans

    def _encoded(self, spans: list[bytes], plain: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of the spans and how many each has, in runs of spans."""
        ids, counts = [], []
        for first in range(0, len(spans), 10_000):
            part = spans[first : first + 10_000]
            if plain:
                ids.append(np.array(self.single.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, np.int32))
                counts.append(np.diff(np.flatnonzero(self.closing[ids[-1]]), prepend=-1))
                if len(counts[-1]) != len(part):
                    raise ValueError(f"{len(part)} words have {len(counts[-1])} last tokens")
            else:
                found = [e.ids for e in self.whole.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)]
                counts.append(np.fromiter(map(len, found), np.int64, len(found)))
                ids.append(np.fromiter(itertools.chain.from_iterable(found), np.int32, int(counts[-1].sum())))
        return ids, counts

    def _forget(self) -> None:
        kept = np.sort(np.argsort(self.used, kind="stable")[-self.limit :])
        count = self.count[kept]
        begin = np.cumsum(count) - count
        at = np.repeat(self.begin[kept] - begin, count) + np.arange(int(count.sum()))
        self.ids = np.concatenate((self.ids[:1], self.ids[at]))
        self.hashes, self.begin, self.count, self.used = self.hashes[kept], begin + 1, count, self.used[kept]

    def find(self, hashes: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of spans with these hashes, ascending and distinct, begin in ``ids``, and how many each has."""
        if len(self.hashes) > 2 * self.limit:
            self._forget()
        self.turn += 1
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != hashes[inside]
        missing = np.flatnonzero(new)
        ids, counts, order = [self.ids], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for kind in (True, False):
            some = missing[plain[missing] == kind]
            more = self._encoded([data[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True)], kind)
            ids += more[0]
            counts += more[1]
            order.append(some)
        count, begin = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
        order, each = np.concatenate(order), np.concatenate(counts)
        count[order], begin[order] = each, len(self.ids) + np.cumsum(each) - each
        where = at[missing]
        self.ids = np.concatenate(ids)
        self.hashes, self.used = np.insert(self.hashes, where, hashes[missing]), np.insert(self.used, where, 0)
        self.begin, self.count = np.insert(self.begin, where, begin[missing]), np.insert(self.count, where, count[missing])
        at += np.cumsum(new) - new
        self.used[at] = self.turn
        return self.begin[at], self.count[at]


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with ASCII and plain spans in lower case; start, end and row of spans that the vocabulary splits at in any case; which are plain.

    Words are cut between letters, ASCII digits and signs, where letters are those of ASCII and Latin-1; not beside apostrophes, which
    may begin an ending of their own, and not in words with ``<|``, which may hold a special token. Plain spans have nothing else in them.
    """
    starts, ends, rows = tb.words(raw, offsets)
    if not len(starts):
        return raw, starts, ends, rows, np.zeros(0, bool)
    letter, digit, sign = _LETTER[raw], _DIGIT[raw], _SIGN[raw]
    accented, lead = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    accented[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] < 0xC0) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    lead[:-1] = accented[1:]
    cut = np.zeros(len(raw), bool)
    opening = letter | lead
    cut[1:] = (letter | accented)[:-1] & (digit | sign)[1:] | digit[:-1] & (opening | digit | sign)[1:] | sign[:-1] & (opening | digit)[1:]
    marked = np.flatnonzero((raw[:-1] == _LESS) & (raw[1:] == _BAR))
    for k in np.unique(np.searchsorted(starts, marked, "right") - 1).tolist():
        cut[starts[k] : ends[k]] = False
    cut[starts] = True
    begins = np.flatnonzero(cut)
    word = np.searchsorted(starts, begins, "right") - 1
    stops = np.minimum(ends[word], np.append(begins[1:], len(raw)))
    special = np.isin(word, np.searchsorted(starts, marked, "right") - 1)
    plain = np.add.reduceat(~(opening | accented | digit | sign | tb.SPACE[raw]), begins, dtype=np.int64) == 0
    plain &= ~special
    wide = np.add.reduceat(raw >= 128, begins, dtype=np.int64) > 0
    wide = (wide | special) & ~plain
    keep = np.concatenate((np.ones(int(begins[0]), bool), np.repeat(wide, np.diff(np.append(begins, len(raw))))))
    lower = np.where(accented & (raw < 0x9F), raw + 32, tb.LOWER[raw])
    return np.where(keep, raw, lower), begins, stops, rows[word], plain


def token_ids(raw: np.ndarray, offsets: np.ndarray, encode: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, each text followed by ``END_ID``, and the offsets of the texts."""
    raw, starts, ends, rows, plain = spans(raw, offsets)
    n = len(offsets) - 1
    counts = tb.lengths_by_row(rows, n)
    hashes, firsts, places = np.unique(tb.word_hashes(raw, starts, ends), return_index=True, return_inverse=True)
    begins, lengths = encode.find(hashes, raw.tobytes(), starts[firsts], ends[firsts], plain[firsts])
    begins, lengths = np.append(begins, 0), np.append(lengths, 1)  # the last is END_ID
    stops = np.cumsum(counts + 1) - 1
    order = np.full(len(places) + n, len(hashes), np.int64)
    inner = np.ones(len(order), bool)
    inner[stops] = False
    order[inner] = places
    each = lengths[order]
    ahead = np.cumsum(each)
    at = np.repeat(begins[order] - (ahead - each), each) + np.arange(int(each.sum()))
    return encode.ids[at], np.concatenate(([0], ahead[stops])).astype(np.int64)


def _piece_batches(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, unit = _encoder(path), TaskContext.get().partitionId()
        used = np.zeros(size + 1, np.int64)
        for batch in batches:
            for first, last, raw, offsets in tb.pieces(batch.column(1)):
                ids, where = token_ids(raw, offsets, encode)
                totals = np.diff(where)
                each = -(-totals // size)
                doc = np.repeat(np.arange(last - first), each)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
                start = piece * size
                length = np.minimum(totals[doc] - start, size)
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                fresh = np.flatnonzero(np.diff(ranked, prepend=-1))
                number = np.empty(len(doc), np.int64)
                number[order] = np.arange(len(doc)) - np.repeat(fresh, np.diff(np.append(fresh, len(doc)))) + used[ranked]
                used += np.bincount(length, minlength=size + 1)
                edges = np.append(where[doc] + start, where[-1])
                data, cuts = memoryview(ids.astype("<u4", copy=False)).cast("B"), (4 * edges).tolist()
                sums = [zlib.crc32(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first).take(pa.array(doc)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids)),
                        pa.array(sums, pa.int64()),
                        pa.array(np.full(len(doc), unit, np.int64)),
                        pa.array(number),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids", "ids_crc32", "unit", "number"],
                )

    return run


@dataclass
class Plan:
    """Places of each length in order: from number ``begin`` on, ``copies`` in every sequence from ``sequence`` on, the first
    at ``offset``. Entries of length l are those from ``first[l]`` to ``first[l + 1]``."""

    first: np.ndarray
    begin: np.ndarray
    copies: np.ndarray
    offset: np.ndarray
    sequence: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these numbers within their lengths."""
        span = int(max(self.begin.max(initial=0), number.max(initial=0))) + 1
        owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        entry = np.searchsorted(owner * span + self.begin, length * span + number, "right") - 1
        step = number - self.begin[entry]
        copies = self.copies[entry]
        return self.sequence[entry] + step // copies, self.offset[entry] + step % copies * length


def _priced(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Greatest price that fits each capacity, and the length to take there (0: leave one token empty)."""
    value, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        found = price[1 : room + 1] + value[room - 1 :: -1]
        best = int(found.argmax())
        value[room] = value[room - 1]
        if found[best] > value[room]:
            value[room], take[room] = found[best], best + 1
    return value, take


def _configuration(first: int, take: list[int], have: list[int], capacity: int) -> tuple[int, ...]:
    """The lengths of one sequence that holds ``first`` and then what the knapsack takes, within the pieces there are."""
    used, room = {first: 1}, capacity - first
    while room > 0:
        length = take[room]
        if length and used.get(length, 0) < have[length]:
            used[length] = used.get(length, 0) + 1
            room -= length
        else:
            room -= 1
    return tuple(x for length in sorted(used, reverse=True) for x in (length, used[length]))


def fractional(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[dict[tuple[int, ...], float], float]:
    """A near-optimal solution of the configuration program, how many sequences of each configuration, and a lower bound.

    In each round a length's price is its weight per piece. Every configuration within ``SLACK`` of the greatest price takes a step
    that covers its leading length once; then lengths lose weight by how much they were covered. The sum over the rounds is
    scaled to cover the typical length once. Prices over the greatest price of a sequence are a dual solution, so they bound every packing.
    """
    lengths = np.flatnonzero(counts)
    have, amount = counts.tolist(), counts[lengths]
    price = np.full(capacity + 1, -np.inf)
    weight = lengths / capacity
    solution: dict[tuple[int, ...], float] = {}
    covered, bound = np.zeros(capacity + 1), 0.0
    for turn in range(rounds):
        price[lengths] = weight
        value, take = _priced(price, capacity)
        bound = max(bound, float(amount @ weight / value[capacity]))
        near = lengths[weight + value[capacity - lengths] >= (1 - SLACK) * value[capacity]]
        steps, gained = take.tolist(), np.zeros(capacity + 1)
        for first in near.tolist():
            one = _configuration(first, steps, have, capacity)
            pairs = dict(zip(one[::2], one[1::2], strict=True))
            step = have[first] / pairs[first]
            solution[one] = solution.get(one, 0.0) + step
            for length, times in pairs.items():
                gained[length] += step * times / have[length]
        covered += gained
        weight = weight * np.exp(-RATE / np.sqrt(1 + turn) * gained[lengths] / gained.max())
    scale = float(np.average(covered[lengths], weights=amount * lengths))
    return {one: x / scale for one, x in solution.items()}, bound


def _filled(one: tuple[int, ...]) -> int:
    return sum(length * times for length, times in zip(one[::2], one[1::2], strict=True))


def _rounded(order: list[tuple[int, ...]], solution: dict[tuple[int, ...], float], counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    left = counts.tolist()
    out: list[tuple[tuple[int, ...], int]] = []

    def fits(one):
        return min(left[length] // times for length, times in zip(one[::2], one[1::2], strict=True))

    def use(one, times):
        for length, each in zip(one[::2], one[1::2], strict=True):
            left[length] -= each * times
        out.append((one, times))

    for up in (False, True):
        for one in order:
            times = min(int(np.ceil(solution[one])) if up else int(solution[one]), fits(one))
            if times > 0:
                use(one, times)
    remaining = [length for length in range(capacity, 0, -1) if left[length]]
    while remaining:
        room, one = capacity, []
        for length in remaining:
            if length <= room:
                times = min(left[length], room // length)
                one += [length, times]
                room -= length * times
        use(tuple(one), fits(tuple(one)))
        remaining = [length for length in remaining if left[length]]
    return out


def rounded(solution: dict[tuple[int, ...], float], counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Whole numbers of sequences: configurations as often as the solution says and pieces are left, first rounded down, then up;
    what is left over goes, longest first, with the longest that still fit.

    The order matters where shares are small, so three are tried (fullest, largest share, longest piece first) and the one
    with the fewest sequences is kept.
    """
    orders = (
        lambda one: (-_filled(one), -solution[one], one),
        lambda one: (-solution[one], -_filled(one), one),
        lambda one: (-one[0], -_filled(one), -solution[one], one),
    )
    tried = (_rounded(sorted(solution, key=key), solution, counts, capacity) for key in orders)
    return min(tried, key=lambda used: sum(times for _, times in used))


def pack_lengths(counts: np.ndarray, capacity: int) -> Plan:
    """``counts[l]`` pieces of each length l up to ``capacity`` put into sequences."""
    counts = np.asarray(counts, np.int64)
    whole = counts.copy()
    whole[:capacity] = 0
    part = counts - whole
    used = [((capacity, 1), int(counts[capacity]))] if counts[capacity] else []
    if part.any():
        used += rounded(fractional(part, capacity)[0], part, capacity)
    rows, begin, sequence = [], np.zeros(capacity + 1, np.int64).tolist(), 0
    for one, times in used:
        offset = 0
        for length, copies in zip(one[::2], one[1::2], strict=True):
            rows.append((length, begin[length], copies, offset, sequence))
            begin[length] += copies * times
            offset += copies * length
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    first = np.searchsorted(table[:, 0], np.arange(capacity + 2))
    return Plan(first, table[:, 1], table[:, 2], table[:, 3], table[:, 4], sequence)


def _place_batches(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            sequence, offset = plan.place(batch.column("length").to_numpy(), batch.column("number").to_numpy())
            kept = [batch.column(i) for i, name in enumerate(names) if name != "number"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)], names=[*(x for x in names if x != "number"), "sequence_id", "offset"]
            )

    return run


def token_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, size: int = SEQUENCE) -> DataFrame:
    """(doc_id, piece, start, length, ids, ids_crc32, unit, number) of every row of ``docs`` (doc_id, text).

    ids are those of the text and one ``END_ID``, cut after every ``size``; ids_crc32 is the unsigned CRC-32 of them as
    little-endian unsigned 32-bit numbers. number counts the pieces of one length
    within a unit (the task that wrote them). NULL and empty texts are the end alone.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_piece_batches(vocabulary, size), _PIECES)


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, size: int = SEQUENCE, ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset) of every piece of every document; without ``ids``, not these.

    The pieces of a sequence follow one another without gaps from offset 0 and hold at most ``size`` tokens. Rows that repeat a
    doc_id, or have none, are documents of their own. NULL and empty texts hold ``END_ID`` alone. Equal lengths are told apart
    by their number only. An empty table gives an empty result; other columns are ignored.

    Pieces are written once to the shared folder. Of them, at most ``size`` counts come to the driver; the plan that goes to the
    tasks has at most ``ROUNDS`` configurations for each length, whatever the number of documents.
    """
    pieces = materialize(token_pieces(docs, vocabulary, size), "token-pieces")
    held = materialize(pieces.groupBy("unit", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = np.zeros(size + 1, np.int64)
    for row in held.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        counts[row.length] = row.n
    plan = pack_lengths(counts, size)
    ahead = Window.partitionBy("length").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select("unit", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    rows = pieces.join(before, ["unit", "length"]).withColumn("number", F.col("number") + F.col("before"))
    kept = [c for c in ("doc_id", "piece", "start", "length", "ids", "ids_crc32") if ids or c != "ids"]
    rows = rows.select(*kept, "number")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*kept).schema.fields)
    return rows.mapInArrow(_place_batches(plan), f"{schema}, sequence_id long, offset long")
