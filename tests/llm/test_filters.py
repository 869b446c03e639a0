"""Toxicity, decontamination and secret scans."""

import hashlib
import random
import re
import time

import numpy as np

from tidemark.llm import decontam, secretscan, toxicity

BAD = ["zorg", "blix", "quang"]


def _labelled(n=900, seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abdeilmnorst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        toxic = int(i % 4 == 0)
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        if toxic:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(BAD) + rng.choice(["", "", "ed", "ing", rng.choice(words)])
        docs.append((i, " ".join(text)))
        labels.append((i, toxic))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = _labelled()
    docs += [(5000, None), (5001, ""), (None, "the zorg"), (5002, "a " * 300_000), (5003, "plain words"), (5003, "plain words")]
    df = spark.createDataFrame([(d, t, 1.0) for d, t in docs], "doc_id long, text string, score double")
    marks = spark.createDataFrame(labels + [(None, 1), (3, None), (99_999, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(df, marks).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    kept = toxicity.drop_toxic(df, marks)
    assert kept.columns == df.columns and kept.where("doc_id >= 5000").count() >= 4


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.toxicity_scores(docs, none).collect()] == [0.5, 0.5]
    assert toxicity.toxicity_scores(docs.limit(0), none).collect() == []


def _brute_spans(text):
    text, found = text or "", []
    kinds = [
        ("assign", r"(?a:(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))", 6),
        ("access", r"(AKIA[A-Z0-9]+)", 20), ("hex", r"([0-9a-f]+)", 24),
    ]
    for place, (kind, pattern, least) in enumerate(kinds):
        found += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, text) if len(m[1]) >= least]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def test_base_spans_equal_plain_patterns(spark):
    key = "AKIA" + "Q7" * 9
    texts = [
        None, "", "no secret here", 'é token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"### x', f"a {key} b AKIA12 AKIA{'Z' * 15}", "PassWord: abc", "PASSWD:abcdef_.=",
        "api_key='a1b2c3d4' apikey=zzzzzz", "f" * 23 + " " + "0" * 24, "tokens token:token=abcdef", "ſecret=abcdefgh toKen=abcdefgh", "ß" * 50_000 + " secret = hunter2hunter2",
        "x" * 19 + "=" + "1", "a" * 30,
    ]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)] + [(None, texts[3], "z"), (3, texts[3], "z")], "doc_id long, text string, spans string")
    got = secretscan.secret_spans(docs).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        wanted = _brute_spans(texts[3 if r.doc_id is None else r.doc_id])
        assert [s for s in r.spans.split(",") if s and not s.startswith("markov")] == wanted
        assert r.base_sha256 == hashlib.sha256(",".join(wanted).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in wanted) for k in ("assign", "access", "hex")]
    assert secretscan.secret_spans(docs.limit(0)).collect() == []


def test_models_add_random_strings_only(spark):
    rng = random.Random(2)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    plain = "the quick brown fox and getUserAccountNumber2 handleRequestFromServer1 internationalization_of_words_2 " * 3
    parts = "get user account number handle request from server inter nation al ization of words Get User Account Number Handle Request".split()
    more = " ".join("".join(rng.choices(parts, k=3)) for _ in range(3000))
    docs = spark.createDataFrame([(1, f"{plain} {key} {plain}"), (2, plain), (3, "token=abcdef99 " + plain), (4, more)], "doc_id long, text string")
    got = {r.doc_id: r for r in secretscan.secret_spans(docs).collect()}
    assert got[1].spans == f"markov:{len(plain) + 1}:{len(plain) + 41}" and got[2].spans == "" and got[3].n_markov == 0
    clean = {r.doc_id: r.text for r in secretscan.redact(docs).collect()}
    assert clean == {1: f"{plain} [SECRET] {plain}", 2: plain, 3: "[SECRET] " + plain, 4: more}


ITEM = "Anna Berg drove 120 km to visit Anna and then paid 35 dollars for the long way back home to her town"


def test_decontamination(spark):
    words = "one two six red blue green tree house river stone light dark north south".split()
    rng = random.Random(4)
    noise = lambda n: " ".join(rng.choice(words) for _ in range(n))
    tail = ITEM.split(" ", 1)[1]
    texts = {
        1: f"{noise(30)} then {tail}. {noise(20)}", 2: f"{noise(9)} so " + tail.replace("Anna", "Mira").replace("120", "77").replace("35", "4"),
        3: f"{noise(9)} so " + tail.replace("visit Anna", "visit Olaf").replace("Berg", "Olaf").replace("120", "35"), 4: noise(400), 5: None, 6: "", 7: f"x {tail.upper()} y",
        8: "a short one here", 9: noise(100_000),
    }
    docs = spark.createDataFrame([(d, t, 0) for d, t in texts.items()] + [(None, ITEM, 0), (1, texts[1], 0)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(10, ITEM, 1), (11, None, 1), (12, "a short one here", 1), (10, ITEM, 1), (None, ITEM, 1)], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs, bench).collect()}
    assert {(1, 10), (2, 10), (8, 12)} <= set(got) and not any(d in (4, 5, 6, 9, None) for d, _ in got)
    assert not got[1, 10].changed and got[2, 10].changed
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {4, 5, 6, 9, None} <= {r.doc_id for r in kept.collect()} and kept.where("doc_id IN (1, 2, 8)").count() == 0
    assert decontam.contaminated(docs.limit(0), bench).collect() == [] and decontam.contaminated(docs, bench.limit(0)).collect() == []


def test_slots_must_map_one_to_one(spark):
    """Two names of the document for one of the item are no re-parameterised question."""
    text = "so Anna went over the bridge and back with Anna until the rain was gone for good that day"
    odd = text.replace("with Anna", "with Olaf")
    docs = spark.createDataFrame([(1, "x " + odd), (2, "x " + text.replace("Anna", "Olaf"))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "x " + text)], "item_id long, text string")
    assert [(r.doc_id, r.changed) for r in decontam.contaminated(docs, bench).collect()] == [(2, True)]


def test_verbatim_items_of_numbers_and_names_are_found(spark):
    dense = "Ann 3 Bob 4 Cid 5 Dan 6 Eve 7 Fay 8 Gus 9 Hal 10"
    asked = "Which of the two long rivers of the north is longer than this one here and why"
    items = [(1, "What is 17 + 25?"), (2, dense), (3, asked), (4, "What is 12 times 13?")]
    texts = {
        1: "look: what is 17 + 25? so it goes", 2: f"then {dense} came", 3: f'words before\n"{asked[:-8]} and why', 4: "so\nWhat is 12 times 14?",
        5: f"words before\n{asked.replace(' here', '')}", 6: "so\nWhat is 12 times 13? Yes",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs, bench).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 3), (5, 3), (6, 4)} and not any(r.changed for r in got.values())


def test_first_word_of_an_item_may_be_a_name_in_the_document(spark):
    item = "Where was the 120 km long road of the town"
    docs = spark.createDataFrame([(1, 'some words\n"' + item.replace("120", "77") + '"')], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [(r.doc_id, r.covered, r.changed) for r in decontam.contaminated(docs, bench).collect()] == [(1, 10, True)]


def test_one_edited_slot_leaves_the_rest_of_a_copy(spark):
    head = "in the year 1990 they began to build a very long bridge over the wide river and through the old town of the north "
    item = head + "which was opened for good in 1990 with a great feast for all who had ever worked on it"
    names = "then Anna took 3 red apples and Bert took 5 green pears to the market"
    texts = {
        1: "x " + item.replace("in 1990 with", "in 1991 with"), 2: "so " + names.replace("3", "4").replace("5", "4"),
        3: "so " + names.replace("Bert", "Olaf").replace("Anna", "Olaf"),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, "x " + item), (2, "so " + names)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs, bench).collect()}
    assert set(got) == {(1, 1), (2, 2)} and got[1, 1].covered >= 30 and got[2, 2].covered == got[2, 2].item_tokens == 16


def test_toxic_wording_late_in_a_text_without_blanks(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(500):
        text = [chr(rng.randrange(0x4E00, 0x4E80)) for _ in range(60)]
        at = rng.randrange(20, 50)
        text[at : at + 3] = "毒坏骂" if i % 2 else "花鸟鱼"
        docs.append((i, "".join(text)))
        labels.append((i, i % 2))
    got = toxicity.toxicity_scores(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert np.mean([r.predicted == r.doc_id % 2 for r in got if r.held_out]) > 0.95


def test_long_runs_are_spelt_from_every_character():
    text = "Ab,一二。三 internationalized"
    raw = np.frombuffer(text.encode(), np.uint8)
    low, starts, ends, rows = toxicity._words(raw, np.array([0, len(raw)]))
    found = [bytes(low[a:b]).decode() for a, b in zip(starts, ends)]
    tail = "internationalized"
    assert found == ["ab", "一二", "三", *(tail[i:] for i in range(len(tail)))] and set(rows) == {0}


def test_many_spans_of_one_text_take_linear_time():
    tables = (np.stack([secretscan.transitions(x[:50]) for x in secretscan.random_strings().values()]), secretscan.transitions(["identifier", "plain_word"]))
    text = " ".join(f"key=value{i:09d} {i:032x}" for i in range(25_000))
    base = secretscan.base_spans(text)
    assert len(base) >= 25_000
    started = time.perf_counter()
    spans = secretscan.model_spans(text, base, tables)
    assert time.perf_counter() - started < 3
    touching = {(a, b) for a, _, b in spans} & {(a, b) for a, _, b in base}
    assert not touching


def test_identifier_pairs_equal_the_plain_way():
    texts = ["", "plain_words token=abcdef12 and more-words", "é plain_words plain_words", "a" * 70 + " abc", "f" * 30 + "é AKIA" + "Z9" * 12, "x1" * 12 + "\nlast-word"]
    wanted = np.zeros((secretscan._N, secretscan._N), int)
    for text in texts:
        base = secretscan.base_spans(text)
        runs = {m[0] for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text) if 4 <= len(m[0]) <= 64 and not any(a < m.end() and m.start() < b for a, _, b in base)}
        for run in runs:
            if not secretscan._is_candidate(run):
                symbols = [0, *secretscan._INDEX[np.frombuffer(run.encode(), np.uint8)]]
                for a, b in zip(symbols, symbols[1:]):
                    wanted[a, b] += 1
    data = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(d) for d in data]))).astype(np.int64)
    assert (secretscan.identifier_pairs(np.frombuffer(b"".join(data), np.uint8), offsets) == wanted).all()


def test_repeated_tokens_take_linear_time(spark):
    docs = spark.createDataFrame([(1, "0 " * 40_000), (2, "1 " * 50)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "0 " * 400), (8, "a b c d 5 " * 60)], "item_id long, text string")
    started = time.perf_counter()
    got = decontam.contaminated(docs, bench).collect()
    assert time.perf_counter() - started < 30  # most of it is planning
    assert [(r.doc_id, r.item_id, r.covered, r.changed) for r in got] == [(1, 7, 400, False)]


def test_items_of_few_words_need_whole_sentences(spark):
    texts = {1: "an answer of any kind", 2: "So. Of! More", 3: "of", 4: "Is it two ways?", 5: "It went. Two ways? Yes", 6: "of\nsome"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, "of"), (2, "two ways")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()) == [(2, 1), (3, 1), (5, 2)]


def test_windows_equal_the_plain_way(spark):
    """Verbatim passages of small random texts: an item's tokens in windows of eight that the document has anywhere."""
    rng = random.Random(11)
    words = [w for w in "red blue green tree house river stone light".split()]
    items = {i: [rng.choice(words[:5]) for _ in range(rng.randint(8, 40))] for i in range(6)}
    docs = {}
    for d in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.7:
            item = items[rng.randrange(6)]
            a = rng.randrange(len(item))
            text[3:3] = item[a : a + rng.randint(1, 30)]
        docs[d] = text
    wanted = set()
    for d, text in docs.items():
        runs = {tuple(text[i : i + 8]) for i in range(len(text) - 7)}
        for i, item in items.items():
            covered = {t for k in range(len(item) - 7) if tuple(item[k : k + 8]) in runs for t in range(k, k + 8)}
            if len(covered) >= min(13, len(item)):
                wanted.add((d, i, len(item), len(covered), False))
    frames = (spark.createDataFrame([(k, " ".join(v)) for k, v in x.items()], f"{name} long, text string") for x, name in ((docs, "doc_id"), (items, "item_id")))
    assert {tuple(r) for r in decontam.contaminated(*frames).collect()} == wanted


def test_decontamination_plans_stay_small(spark):
    """Leaves of one plan start together and each costs the driver memory, so what is left to run last reads few tables."""
    docs = spark.createDataFrame([(1, f"then {ITEM}"), (2, "other words")], "doc_id long, text string")
    bench = spark.createDataFrame([(10, ITEM)], "item_id long, text string")
    for df, most in ((decontam.contaminated(docs, bench), 3), (decontam.drop_contaminated(docs, bench), 2)):
        assert df._jdf.queryExecution().optimizedPlan().collectLeaves().size() <= most
