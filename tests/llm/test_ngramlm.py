import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import ngramlm


def brute(rows):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for _, t in rows]
    out = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    c, pairs, before = Counter(), Counter(), Counter()
    for t, held in zip(tokens, out):
        if not held:
            c.update(t)
    n, v = sum(c.values()), len(c)
    least = ngramlm.LEAST_FREQUENT
    cls = lambda w: w if w is None or c[w] >= least else "rare"
    for t, held in zip(tokens, out):
        if not held:
            for a, b in zip(["start", *map(cls, t[:-1])], map(cls, t)):
                pairs[a, b] += 1
                before[a] += 1
    scale = n + 0.5 * (v + 1)
    share = lambda w: (c[w] + 0.5) / scale
    rare = (sum(x + 0.5 for w, x in c.items() if cls(w) == "rare") + 0.5) / scale
    result = []
    for (d, _), t, held in zip(rows, tokens, out):
        score = 0.0
        for a, b in zip(["start", *map(cls, t[:-1])], t):
            p = share(b) if cls(b) != "rare" else rare
            q = (pairs[a, cls(b)] + ngramlm.STRENGTH * p) / (before[a] + ngramlm.STRENGTH)
            score += math.log10(q * share(b) / p)
        result.append((d, held, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10(share(w)) for w in t), score))
    return result


@pytest.mark.parametrize("least", [5, 30])
def test_equals_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(ngramlm, "UNIT", 3000)
    monkeypatch.setattr(ngramlm, "RANGE", 5000)
    monkeypatch.setattr(ngramlm, "LEAST_FREQUENT", least)
    rng = random.Random(3)
    vocabulary = ["The", "of", "é", "ß,", "x" * 300] + [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, [200] * 4 + [1] * 401, k=rng.randint(0, 90)))) for i in range(300)]
    rows += [(None, "the of"), (None, None), (900, None), (901, ""), (902, " \n"), (7, rows[7][1]), (903, "long of " * 20_000)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, score int").repartition(4)
    got = sorted(map(tuple, ngramlm.score_texts(docs).collect()), key=lambda r: (str(r[0]), r[2]))
    wanted = sorted(brute(rows), key=lambda r: (str(r[0]), r[2]))
    assert [r[:5] for r in got] == [r[:5] for r in wanted]
    for a, b in zip(got, wanted):
        assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9)


def test_empty_table(spark):
    assert ngramlm.score_texts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_equal_counts_make_equal_states_in_any_corpus():
    keys = np.arange(4, dtype=np.uint64)
    counts = np.array([0, ngramlm.LEAST_FREQUENT - 1, ngramlm.LEAST_FREQUENT, 10**9])
    assert ngramlm._are_frequent(keys, counts).tolist() == [False, False, True, True]
    assert ngramlm._are_frequent(keys[:3], counts[:3]).tolist() == [False, False, True]
