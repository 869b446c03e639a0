import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import collocations as co


def plain(rows, least, top):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    key = lang, tuple(words[i : i + k])
                    f[key] = f.get(key, 0) + 1
    chosen = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    covered = {
        (lang, p[i : i + k]) for (lang, p), a in chosen.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
        if 100 * a >= 80 * f[lang, p[i : i + k]]
    }
    out = []
    for lang in n:
        found = []
        for (its, p), a in chosen.items():
            if its == lang and (its, p) not in covered:
                score, _, l, r = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
WORDS = ["a", "B", "c", "of", "the", "Über", "x-y", "é", ".", ",", "\n", "\t", "!", " "]


@pytest.mark.parametrize("heavy,unit,route", [(1 << 20, 8 << 20, 1 << 20), (40, 300, 50), (5, 200, 20)])
def test_phrases_equal_the_plain_way(spark, rows, monkeypatch, heavy, unit, route):
    for name, value in (("HEAVY", heavy), ("UNIT", unit), ("ROUTE", route)):
        monkeypatch.setattr(co, name, value)
    rng = np.random.default_rng(1)
    weights = np.array([8, 5, 3, 8, 8, 2, 1, 1, 2, 1, 1, 1, 1, 1.0])
    texts = [" ".join(rng.choice(WORDS, 40, p=weights / weights.sum())) for _ in range(40)]
    texts += ["one very long shared passage of words, again"] * 12 + [None, "", " ", "the " * 300]
    given_rows = [([None, "en", "und", "de"][i % 4], t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, "z", 1, 2) for r in given_rows], "lang string, text string, word string, n int, unit int").repartition(3)
    assert rows(co.collocations(docs, least=5, top=30), *COLUMNS) == plain(given_rows, 5, 30)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert co.collocations(docs).collect() == []
    assert co.collocations(spark.createDataFrame([(None, None), ("en", "rare words only")], docs.schema)).collect() == []


def test_counts_past_64_bits(spark, rows):
    big = 10**13
    phrases = spark.createDataFrame([([0, 1], 0, big), ([0, 1, 2], 0, big // 2), ([1, 2], 1, big - 1)], "words array<int>, id int, a long")
    words = spark.createDataFrame([(i, "en", "w", big + i) for i in range(3)], "id int, lang string, word string, total long")
    got = {tuple(r.words): (r.score, r.l, r.r) for r in co.scored_phrases(phrases, words).collect()}
    assert got[0, 1] == (2_000_000 * big // (2 * big + 1), big, big + 1)
    assert got[0, 1, 2] == (2_000_000 * (big // 2) // (2 * big + 2), big, big + 2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-1, 3), min_size=0, max_size=30), max_size=6), st.integers(1, 6), st.integers(2, 4))
def test_sorting_counts_every_prefix(texts, least, whole):
    ids = np.array([x for t in texts for x in [*t, -1]], np.int32)
    words, number = co.suffixes(ids)
    got_words, got = co.sorted_counts(words, number, least, whole)
    found = Counter()
    for t in ids.tolist() and [list(map(int, p.split())) for p in " ".join(map(str, ids.tolist())).split("-1")]:
        for i in range(len(t)):
            for k in range(2, 5):
                if i + k <= len(t):
                    found[tuple(t[i : i + k])] += 1
    wanted = {p: n for p, n in found.items() if n >= least or len(p) < whole}
    assert {tuple(x for x in w if x >= 0): n for w, n in zip(got_words.T.tolist(), got.tolist(), strict=True)} == wanted
    assert got_words.shape[1] == len(wanted)


def test_sql_says_the_same():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (lang VARCHAR, text VARCHAR)")
    rng = np.random.default_rng(2)
    given_rows = [(["en", None][i % 2], " ".join(rng.choice(WORDS, 60))) for i in range(300)]
    con.executemany("INSERT INTO documents VALUES (?, ?)", given_rows)
    assert sorted(con.execute(co.COLLOCATIONS_SQL).fetchall()) == plain(given_rows, 30, 2000)


def test_batches_to_spark_are_bounded(monkeypatch):
    monkeypatch.setattr(co, "SENT", 50)
    rng = np.random.default_rng(3)
    tokens = rng.integers(-1, 40, 2000).astype(np.int32)
    unit = pa.table({"unit": [0], "token": pa.array([tokens], pa.list_(pa.int32()))})
    answers = pa.table({"asking": [0] * 40, "at": range(40), "id": pa.array(range(40), pa.int32()), "total": [co.HEAVY + 1] * 40})
    routed = co._route_unit(30)(unit, answers)
    words, number = co.suffixes(tokens)
    assert routed.num_rows > 30 and sum(len(x) for x in routed["n"]) == len(number)
    assert all(b.num_rows == 1 or len(b.column("n").flatten()) <= 50 for b in routed.to_batches())
    four = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([4]), pa.array([words.T.reshape(-1)]), pa.array([number])], names=["route", "whole", "suffix", "n"])
    found = list(co._count_route(1)(iter([four, four])))
    assert len(found) > 1 and all(b.num_rows <= 50 for b in found)
    got = {tuple(w): n for b in found for *w, n in zip(*(c.to_pylist() for c in b.columns), strict=True)}
    wanted = co.sorted_counts(words, 2 * number, 1, 4)
    assert got == dict(zip(map(tuple, wanted[0].T.tolist()), wanted[1].tolist(), strict=True))


def test_a_unit_is_looked_at_in_parts(monkeypatch):
    texts = pa.array(["the Cat. the cat", None, "", "a cat, the end " * 40, "The END"])
    code = np.array([0, 1, 0, 1, 1], np.uint64)
    whole = co._unit_words(texts, code)
    monkeypatch.setattr(co.tb.pieces, "__defaults__", (10,))
    parts = co._unit_words(texts, code)
    assert [x if isinstance(x, list) else x.tolist() for x in parts] == [x if isinstance(x, list) else x.tolist() for x in whole]
    assert whole[2].sum() == (whole[3] >= 0).sum() == 4 + 160 + 2
