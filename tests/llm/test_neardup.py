import itertools
import random
import re

import pytest
from pyspark import cloudpickle

from tidemark.llm import components, decontam, neardup, secretscan, toxicity


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """rows: doc_id to text; all pairs, then components."""
    sets = {d: _set(t) for d, t in rows.items()}
    label = {d: d for d in rows}
    pairs = [
        (a, b) for a, b in itertools.combinations(sorted(sets), 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {d: (len(sets[d]), label[d], label[d] == d) for d in rows}


def made(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7)))
    texts, passage = {}, [word() for _ in range(60)]
    for group in range(12):
        base = [word() for _ in range(rng.choice([3, 8, 40, 200, 600]))]
        for _ in range(rng.randint(1, 25)):
            own = [word() if rng.random() < rng.choice([0, 0.01, 0.03, 0.06]) else w for w in base]
            texts[len(texts) * 3 + 1] = rng.choice([" ", "\n", "\t "]).join(own)
    for _ in range(40):
        texts[len(texts) * 3 + 1] = " ".join(passage + [word() for _ in range(rng.randint(5, 60))])
    texts[5000] = texts[1].upper()
    texts |= {6000: None, 6002: "", 6003: " \n\t", 6004: "one two", 6005: "One  two", 6006: "one two three", 6007: "x" * 200_000}
    return texts


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_equals_brute_force(spark, monkeypatch, rounds):
    """With 0 star rounds all links come from the blocks, which are small here."""
    monkeypatch.setattr(neardup, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(neardup, "BLOCK", 7)
    monkeypatch.setattr(neardup, "SENT_IDS", 10 if rounds == 1 else 1_000_000)
    texts = made(rounds)
    docs = spark.createDataFrame([(d, t, "z") for d, t in texts.items()], "doc_id long, text string, component_id string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs.repartition(5)).collect()}
    assert got == brute(texts)


def test_repeated_ids_null_ids_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, neardup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (2, 2, 1, False), (None, 2, None, True), (None, 0, None, True)], key=str)
    assert neardup.near_duplicates(docs.limit(0)).collect() == []


def test_sketches_fill_and_estimate():
    sets = neardup.shingle_sets(*_bytes([" ".join(map(str, range(n))) for n in (1, 5, 30, 3000, 3300)]))
    marks = neardup.sketches(sets)
    assert marks.shape == (5, neardup.SIZE)
    agreement = (marks[3] == marks[4]).mean()
    assert abs(agreement - 2996 / 3296) < 0.12


def _bytes(texts):
    import pyarrow as pa

    from tidemark.llm import textbytes

    (_, _, raw, offsets), = textbytes.pieces(pa.array(texts))
    return raw, offsets


def test_components_that_are_stars_take_no_round(spark, monkeypatch):
    written, own = [], components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, label: written.append(label) or own(df, label))
    stars = [(1, 2), (1, 3), (1, 2), (9, 4), (5, 5), (None, 1)]
    got = components.components(spark.createDataFrame(stars, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (3, 1), (4, 4), (9, 4)] and len(written) == 1
    chain = [(i, i + 1) for i in range(20, 40)] + stars + [(3, 9)]
    got = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == [(i, 1) for i in (1, 2, 3, 4, 9)] + [(i, 20) for i in range(20, 41)]


def test_dropping_keeps_one_of_each_group_in_few_jobs(spark):
    rows = [*made(2).items(), (None, "x y z"), (None, None), (1, made(2)[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = brute(dict(rows[:-3]))
    spark.sparkContext.setJobGroup("drop", "")
    left = neardup.drop_near_duplicates(docs)
    got = sorted(left.collect(), key=str)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("drop"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    wanted = [r for r in rows[:-1] if r[0] is None or found[r[0]][2]]
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == sorted((d or -1, t or "") for d, t in wanted)
    assert jobs < 106  # 116 when each search of components ran a round more and texts were shuffled


def test_functions_go_to_tasks_without_what_the_driver_has_worked_out():
    neardup.shingle_sets(*_bytes(["one two three four five six"]))  # fills the cache of powers, 8 MB each
    for task in (neardup._sketch_batches, decontam._window_batches([8]), secretscan._redactor(None, 0, ""), toxicity._scorer(None, True)):
        assert len(cloudpickle.dumps(task)) < 200_000
