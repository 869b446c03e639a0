"""Phrases of two to four words that occur together more than their parts, by sorting pointers to suffixes.

A suffix is a word and up to three that follow it in its piece. Only words frequent enough for any phrase keep numbers; others end a
suffix. Suffixes are routed by their two leading words to tasks that sort pointers to them by multikey three-way quicksort, down to
four words: the equal part of each partition is a phrase and its size the count. Partitions too small for any phrase are
abandoned unsorted.

Leading words that are both very frequent are routed by three words, or by all four. Their shorter phrases then come in parts,
which are added up. Which ones is told from the words' own counts, so a route has a bounded number of suffixes of one kind.
Equal suffixes of a unit of texts travel once, with their number.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.session import arrow_batches, materialize

DEPTH, LEAST, TOP = 4, 30, 2000
#: A phrase goes if a longer one around it has so many of each hundred of its occurrences.
COVERED = 80
SCALE = 2_000_000
#: Bytes of text of a unit, training words for each route, occurrences from which leading words are routed deeper, rows of a batch to Spark.
UNIT, ROUTE, HEAVY, SENT = 8 << 20, 1 << 19, 1 << 20, 1 << 16
#: Units of a stored file: Spark reads and writes up to thousands of rows of a file at once.
FILE_UNITS = 2
NO_LANGUAGE = "und"

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
_BETWEEN = _BREAK.copy()
_BETWEEN[[9, 32]] = True

_UNIT = "unit long, lang array<string>, word array<string>, n array<long>, token array<int>"
_SUFFIXES = "route int, whole int, suffix array<int>, n array<long>"
_ROUTED = pa.schema([("route", pa.int32()), ("whole", pa.int32()), ("suffix", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])
_PHRASES = "w0 int, w1 int, w2 int, w3 int, n long"


def piece_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word, and whether it is the first of its piece."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(bool)
    solid = ~_BETWEEN[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    stops[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    rows = np.searchsorted(offsets, starts, "right") - 1
    piece = np.cumsum(_BREAK[raw])[starts]
    first = np.ones(len(starts), bool)
    first[1:] = (piece[1:] != piece[:-1]) | (rows[1:] != rows[:-1])
    return starts, np.flatnonzero(stops) + 1, rows, first


def _unit_words(texts: pa.Array, code: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Language code, bytes and number of the different words of some texts, and the places of all words, -1 before each piece.

    About ``tb.PIECE`` bytes are looked at together: only a place for each word is kept of the whole.
    """
    keys, langs, words, counts, tokens = [], [], [], [], []
    for first, last, raw, offsets in tb.pieces(texts):
        data = raw.tobytes().lower()  # A-Z only
        raw = np.frombuffer(data, np.uint8)
        starts, ends, rows, opening = piece_words(raw, offsets)
        its = code[first:last][rows]
        found, firsts, places, number = np.unique(
            tb.span_hashes(raw, starts, ends) ^ tb.mix(its + np.uint64(1)), return_index=True, return_inverse=True, return_counts=True
        )
        token = np.full(len(places) + int(opening.sum()), -1, np.int32)
        token[np.arange(len(places)) + np.cumsum(opening)] = places
        keys.append(found)
        langs.append(its[firsts])
        words += [data[a:b] for a, b in zip(starts[firsts].tolist(), ends[firsts].tolist(), strict=True)]
        counts.append(number)
        tokens.append(token)
    _, firsts, places = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    total = np.zeros(len(firsts), np.int64)
    np.add.at(total, places, np.concatenate(counts))
    ahead = 0
    for found, token in zip(keys, tokens, strict=True):
        at = np.flatnonzero(token >= 0)
        token[at] = places[ahead + token[at]]
        ahead += len(found)
    return np.concatenate(langs)[firsts], [words[k] for k in firsts.tolist()], total, np.concatenate(tokens)


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units of whole texts: their words by language, with counts, and the places of all words, -1 before each piece."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        langs = pc.dictionary_encode(batch.column(0).fill_null(NO_LANGUAGE))
        names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy().astype(np.uint64)
        for first, last, _, _ in tb.pieces(batch.column(1), UNIT):
            code, words, counts, tokens = _unit_words(batch.column(1).slice(first, last - first), codes[first:last])
            spoken = [names[k] for k in code.tolist()]
            lists = (pa.array(spoken, pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts), pa.array(tokens))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists)],
                names=["unit", "lang", "word", "n", "token"],
            )
            number += 1


def suffixes(ids: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(depth, n) array of the different suffixes of two and more words, -1 after their end, and how often each occurs."""
    padded = np.concatenate((ids, np.full(depth - 1, -1, ids.dtype)))
    columns = [ids]
    for k in range(1, depth):
        columns.append(np.where(columns[-1] < 0, -1, padded[k : k + len(ids)]))
    kept = columns[1] >= 0
    columns = [c[kept] for c in columns]
    key = columns[0].astype(np.int64)
    for column in columns[1:]:
        _, key = np.unique(key * (int(column.max(initial=0)) + 2) + column + 1, return_inverse=True)
    _, firsts, counts = np.unique(key, return_index=True, return_counts=True)
    return np.stack([c[firsts] for c in columns]), counts


def _route_unit(parts: int):
    def run(units: pa.Table, answers: pa.Table) -> pa.Table:
        body = units.column("token").combine_chunks().flatten().to_numpy()
        size = int(body.max(initial=-1)) + 2
        ids, counts = np.full(size, -1, np.int32), np.zeros(size, np.int64)
        at = answers.column("at").to_numpy()
        ids[at], counts[at] = answers.column("id").to_numpy(), answers.column("total").to_numpy()
        words, number = suffixes(np.where(body < 0, -1, ids[body]))
        order = np.argsort(ids, kind="stable")
        by_id, totals = ids[order], counts[order]

        def total(column: np.ndarray) -> np.ndarray:
            return np.where(column < 0, 0, totals[np.minimum(np.searchsorted(by_id, column), size - 1)])

        low = np.minimum(total(words[0]), total(words[1]))
        whole = 2 + (low > HEAVY).astype(np.int64) + (np.minimum(low, total(words[2])) > HEAVY)
        key = tb.mix(words[0].astype(np.uint64) << np.uint64(32) | words[1].astype(np.uint64))
        for k in (2, 3):
            key = np.where(whole > k, tb.mix(key ^ (words[k].astype(np.int64) + k * (1 << 40)).astype(np.uint64)), key)
        kind = (key % np.uint64(parts)).astype(np.int64) * 8 + whole
        order = np.argsort(kind, kind="stable")
        edges = np.append(np.flatnonzero(np.diff(kind[order], prepend=-1)), len(order))
        heads = kind[order][edges[:-1]]
        batches, first = [], 0
        while first < len(heads):  # a batch of about SENT suffixes, so nothing between here and Spark holds all of them again
            last = max(int(np.searchsorted(edges, edges[first] + SENT, "right")) - 1, first + 1)
            chosen, inner = order[edges[first] : edges[last]], edges[first : last + 1] - edges[first]
            batches.append(pa.RecordBatch.from_arrays([
                pa.array((heads[first:last] // 8).astype(np.int32)), pa.array((heads[first:last] % 8).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array((inner * DEPTH).astype(np.int32)), pa.array(np.ascontiguousarray(words[:, chosen].T).reshape(-1))),
                pa.ListArray.from_arrays(pa.array(inner.astype(np.int32)), pa.array(number[chosen])),
            ], schema=_ROUTED))
            first = last
        return pa.Table.from_batches(batches, _ROUTED)

    return run


def sorted_pieces(words: np.ndarray, number: np.ndarray, least: int, whole: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrases of two and more words among suffixes, a column each with -1 after its end, and their counts, as they are found.

    Multikey three-way quicksort of pointers, all open partitions at once: a partition whose suffixes agree in ``deep`` words is split by the
    next word into less, equal and greater than the median of three; the equal part agrees in one word more and is a phrase. Phrases of
    ``whole`` words and more have all their suffixes here: they need ``least``, and partitions that hold only such are
    abandoned below it. Shorter ones are part counts and all returned.
    """
    depth, n = words.shape
    pointer = np.arange(n)
    start, size, deep = np.zeros(min(n, 1), np.int64), np.full(min(n, 1), n), np.zeros(min(n, 1), np.int64)
    while len(start):
        part = np.repeat(np.arange(len(start)), size)
        base = np.cumsum(size) - size
        at = pointer[np.arange(len(part)) + (start - base)[part]]
        word = words[deep[part], at]
        a, b, c = word[base], word[base + size // 2], word[base + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
        against = pivot[part]
        below = np.zeros(len(start), np.int64)
        following = []
        for side in (word < against, word == against, word > against):
            chosen = np.flatnonzero(side)
            owner = part[chosen]
            amount = np.bincount(owner, minlength=len(start))
            moved = at[chosen]
            pointer[(start + below - (np.cumsum(amount) - amount))[owner] + np.arange(len(chosen))] = moved
            weight = np.bincount(owner, number[moved], len(start)).astype(np.int64)
            following.append((start + below, amount, weight))
            below = below + amount
        (s0, n0, w0), (s1, n1, w1), (s2, n2, w2) = following
        more = deep + 1
        phrase = (pivot >= 0) & (more >= 2) & ((w1 >= least) | (more < whole))
        if phrase.any():
            taken = words[:, pointer[s1[phrase]]].copy()
            taken[np.arange(depth)[:, None] >= more[phrase]] = -1
            yield taken, w1[phrase]
        open_sides = [(n > 0) & ((w >= least) | (np.maximum(more, 2) < whole)) for n, w in ((n0, w0), (n2, w2))]
        open_equal = (pivot >= 0) & (more < depth) & ((w1 >= least) | (np.maximum(more + 1, 2) < whole))
        start = np.concatenate((s0[open_sides[0]], s1[open_equal], s2[open_sides[1]]))
        size = np.concatenate((n0[open_sides[0]], n1[open_equal], n2[open_sides[1]]))
        deep = np.concatenate((deep[open_sides[0]], more[open_equal], deep[open_sides[1]]))


def sorted_counts(words: np.ndarray, number: np.ndarray, least: int, whole: int) -> tuple[np.ndarray, np.ndarray]:
    """All of ``sorted_pieces``."""
    found = [(words[:, :0], np.zeros(0, np.int64)), *sorted_pieces(words, number, least, whole)]
    return np.concatenate([x for x, _ in found], axis=1), np.concatenate([x for _, x in found])


def _count_route(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, flat, number = 2, [], []
        for batch in batches:  # one kind in a group
            whole = batch.column("whole")[0].as_py()
            flat.append(batch.column("suffix").flatten().to_numpy())
            number.append(batch.column("n").flatten().to_numpy())
        words, number = np.concatenate(flat).reshape(-1, DEPTH).T, np.concatenate(number)
        flat.clear()
        found, held = [], 0
        for piece in itertools.chain(sorted_pieces(words, number, least, whole), [None]):
            if piece is not None:
                found.append(piece)
                held += len(piece[1])
            if held >= SENT or held and piece is None:
                columns = [*np.concatenate([x for x, _ in found], axis=1).astype(np.int32), np.concatenate([x for _, x in found])]
                found, held = [], 0
                for first in range(0, len(columns[0]), SENT):
                    yield pa.RecordBatch.from_arrays([pa.array(x[first : first + SENT]) for x in columns], names=["w0", "w1", "w2", "w3", "n"])

    return run


def _numbered(counts: DataFrame, least: int) -> DataFrame:
    """(id, lang, word, total) of the words with ``least`` occurrences, numbered from 0."""
    rows = counts.where(F.col("total") >= least)
    rows = rows.select("*", F.spark_partition_id().alias("part"), (F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).alias("at"))
    rows = materialize(rows, "words")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    first = rows.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
    return rows.join(F.broadcast(first), "part").select((F.col("first") + F.col("at")).cast("int").alias("id"), "lang", "word", "total")


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, id, a) of the phrases of two to four words with ``least`` occurrences, (id, lang, word, total) of the
    words with as many, and (lang, n) of all. words are the ids of a phrase in order."""
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    with arrow_batches(docs.sparkSession, UNIT):
        units = materialize(rows.mapInArrow(_unit_batches, _UNIT), "phrase-units", file_rows=FILE_UNITS)
    listed = units.select("unit", F.posexplode(F.arrays_zip("lang", "word", "n")).alias("at", "x")).select("unit", "at", "x.*")
    counts = materialize(listed.groupBy("lang", "word").agg(F.sum("n").alias("total")), "word-totals")
    sizes = counts.groupBy("lang").agg(F.sum("total").alias("n"))
    words = materialize(_numbered(counts, least), "numbered")
    parts = 1 + (counts.agg(F.sum("total")).first()[0] or 0) // ROUTE
    asked = listed.select(F.col("unit").alias("asking"), "at", F.col("lang").alias("its"), F.col("word").alias("own"))
    answers = asked.join(words, (F.col("its") == F.col("lang")) & (F.col("own") == F.col("word"))).select("asking", "at", "id", "total")
    routed = units.select("unit", "token").groupBy("unit").cogroup(answers.groupBy("asking")).applyInArrow(_route_unit(parts), _SUFFIXES)
    found = routed.groupBy("route", "whole").applyInArrow(_count_route(least), _PHRASES)
    found = found.groupBy("w0", "w1", "w2", "w3").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    numbers = F.filter(F.array("w0", "w1", "w2", "w3"), lambda w: w >= 0)
    with arrow_batches(docs.sparkSession, UNIT):
        phrases = materialize(found.select(numbers.alias("words"), F.col("w0").alias("id"), "a"), "phrases")
    return phrases, words, sizes


def scored_phrases(phrases: DataFrame, words: DataFrame, covered: int = COVERED) -> DataFrame:
    """(words, id, a, l, r, score) of the phrases that no longer phrase covers, by the cut of the lowest score.

    The score of a cut is floor(``SCALE`` a / (l + r)) in whole numbers, l and r the counts of both sides; ties go to the earlier cut.
    """
    size = F.size("words")
    inner = phrases.where(size > 2).select(
        "a", "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("long")
    ).select("a", F.explode(F.transform(F.sequence(F.lit(1), size - F.col("long") + 1), lambda k: F.slice("words", k, F.col("long")))).alias("words"))
    around = inner.groupBy("words").agg(F.max("a").alias("longer"))
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    kept = phrases.join(around, "words", "left").where(F.col("longer").isNull() | (100 * whole("longer") < covered * whole("a"))).select("words", "id", "a")
    single = words.select(F.array("id").alias("part"), F.col("total").alias("f"))
    known = phrases.select(F.col("words").alias("part"), F.col("a").alias("f")).unionByName(single)
    cuts = kept.select("words", "id", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.slice("words", 1, F.col("k")).alias("part")),
        F.struct(F.lit(1).alias("side"), F.slice("words", F.col("k") + 1, size - F.col("k")).alias("part")),
    )
    cuts = cuts.select("words", "id", "a", "k", F.inline(sides)).join(known, "part")
    cuts = cuts.groupBy("words", "id", "a", "k").agg(F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    score = F.expr(f"cast((cast({SCALE} as decimal(17,0)) * cast(a as decimal(20,0))) div cast(l + r as decimal(20,0)) as long)")
    cuts = cuts.withColumn("score", score)
    return cuts.groupBy("words", "id", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m")).select("words", "id", "a", "m.l", "m.r", "m.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language of ``docs`` (lang, text).

    A-Z are lowered; pieces end at ``[.,;:!?]`` and line breaks, words are runs without space and tab. All counts are per language, and
    over whole texts; NULL lang is ``NO_LANGUAGE``, NULL text is empty. a counts a phrase, overlaps included, l and r the parts of its cut, n
    all words of the language. Phrases inside a longer one with ``COVERED`` of 100 of their occurrences are dropped.
    Order: score, then a descending, then phrase by its bytes. Repeated rows count each time. An empty table gives no rows; other columns are
    ignored. At most 2^31 words may reach ``least``; words of one unit are told apart by 64-bit hashes.
    """
    phrases, words, sizes = phrase_counts(docs, least)
    scored = materialize(scored_phrases(phrases, words), "scored").join(words.select("id", "lang"), "id")
    order = [F.col("score").desc(), F.col("a").desc()]
    first = scored.withColumn("at", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("at") <= top).drop("at")
    first = materialize(first, "first-phrases")
    spelled = first.select("words", F.posexplode("words").alias("pos", "id")).join(words.select("id", "word"), "id")
    spelled = spelled.groupBy("words").agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("x"))  # four words at most
    spelled = spelled.select("words", F.array_join(F.col("x.word"), " ").alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    ranked = first.join(spelled, "words").withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same rows in DuckDB. Phrases are joined with one space, which no word holds.
COLLOCATIONS_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split WHERE len(w) > 0
), grams AS (
  SELECT lang, w[i : i + k - 1] AS g, k FROM places, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)
), f AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, any_value(g) AS g, any_value(k) AS k, count(*) AS a
  FROM grams GROUP BY 1, 2
), size AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1
), c AS (
  SELECT * FROM f WHERE k >= 2 AND a >= {LEAST}
), covered AS (
  SELECT DISTINCT s.lang, s.phrase FROM (
    SELECT lang, a, array_to_string(g[j : j + m - 1], ' ') AS inner_phrase
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS j FROM (SELECT *, unnest(range(2, k)) AS m FROM c))
  ) x JOIN c s ON s.lang = x.lang AND s.phrase = x.inner_phrase WHERE 100 * x.a::HUGEINT >= {COVERED} * s.a::HUGEINT
), cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, l.a AS l, r.a AS r, ({SCALE} * c.a::HUGEINT // (l.a + r.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.g[1 : cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.g[cut + 1 : c.k], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best ANTI JOIN covered USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN size USING (lang) WHERE rank <= {TOP}
"""
