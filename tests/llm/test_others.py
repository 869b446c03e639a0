"""Mixing, search, archives, languages, the pipeline and the queries' SQL."""

import io
import itertools
import math
import random

import duckdb
import oracle
import pytest

import __spark_entry__ as entry_points
from tidemark.llm import archives, langid, mixing, queries, topk


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf, name):
    assert oracle.differences(queries.QUERIES[name](spark, sf), oracle.connect(sf), queries.SQL[name]) is None


def test_mixing_ties_nulls_and_repeats(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["a", "b", "é", None, "B"]), 1) for i in range(200)]
    rows += [(i, "one  two\nthree", "b", 2) for i in (7, 7, 7)] + [(None, "x y", "a", 3), (None, None, None, 4), (900, "long " * 60_000, "a", 5), (901, None, "empty", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, target int")
    got = mixing.mixed_by_source(docs).select("doc_id", "size", "source_size", "target", "taken")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR, x INT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    assert oracle.differences(got, con, mixing.MIX_SQL.format(docs="documents", columns="d.doc_id AS doc_id")) is None
    assert got.where("taken > 3 * size").count() == 0 and got.count() == len(rows)
    assert mixing.mixed_by_source(docs.limit(0)).collect() == []


def test_min_cost_flow_equals_brute_force():
    rng = random.Random(9)
    for _ in range(30):
        offers = [(rng.randint(0, 2), rng.sample(range(3), rng.randint(1, 3))) for _ in range(3)]
        quotas = [rng.randint(0, 4) for _ in range(3)]
        flows = mixing.min_cost_flow(offers, quotas)
        ways = [[f for f in itertools.product(range(5), repeat=len(m)) if sum(f) <= 3 * w] for w, m in offers]
        price = lambda w, n: sum(max(0, min(n - r * w, w)) * r for r in range(3))
        best = (-1, 0)
        for choice in itertools.product(*ways):
            into = [0] * 3
            for (_, m), f in zip(offers, choice):
                for s, x in zip(m, f):
                    into[s] += x
            if all(x <= q for x, q in zip(into, quotas)):
                best = max(best, (sum(into), -sum(price(w, sum(f)) for (w, _), f in zip(offers, choice))))
        sent = [sum(f.values()) for f in flows]
        assert (sum(sent), -sum(price(w, n) for (w, _), n in zip(offers, sent))) == best
        assert all(sum(f.get(s, 0) for f in flows) <= q for s, q in enumerate(quotas))


def test_documents_of_several_sources(spark):
    from pyspark.sql import functions as F

    rows = [(1, "w " * 10, ["a", "b"]), (2, "w " * 10, ["b"]), (3, "w " * 4, None), (4, "w " * 6, ["a", "a"])]
    taken, shares = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, sources array<string>"), F.col("sources"))
    got = {r.doc_id: r.taken for r in taken.collect()}
    targets = {r.source: r.target for r in shares.collect()}
    assert got[3] == 0 and sum(got.values()) == sum(math.floor(t) for t in targets.values())


def test_top_scores_with_ties_and_bad_vectors(spark):
    rng = random.Random(3)
    vec = lambda: [rng.choice([-1.0, 0.25, 0.5, 0.999, 40.0]) for _ in range(6)]
    rows = [(i, vec(), 1) for i in range(0, 160)] + [(500, None, 1), (550, [], 1), (600, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (650, [float("nan")] * 6, 1), (700, [float("inf")] * 6, 1), (None, vec(), 1), (750, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", [r[:2] for r in rows if r[0] is not None])
    assert oracle.differences(topk.top_scores(df), con, topk.TOP_SQL) is None
    assert topk.top_scores(df.limit(0)).collect() == []


def test_search_stops_on_proof_and_stays_exact(monkeypatch):
    import numpy as np

    monkeypatch.setattr(topk, "FEW", 8)
    rng = np.random.default_rng(0)
    vectors = np.floor(256 * rng.normal(size=(3000, 16)) * rng.choice([0.1, 1, 3], size=(3000, 1))).astype(np.int64)
    asked = vectors[::100]
    own = np.arange(3000)[None, :] == np.arange(0, 3000, 100)[:, None]
    for i, (at, score) in enumerate(topk.Block(vectors).search(asked, own, 5)):
        full = np.where(own[i], np.iinfo(np.int64).min, vectors @ asked[i])
        assert sorted(score)[-5:] == sorted(full)[-5:]


def test_archives_round_trip(spark):
    import base64
    import hashlib

    html = ["<p>é</p>", "a\r\n\r\nb\n\nWARC/1.1\r\n", None, "", "<p>é</p>", "x" * 300_000, "<p>é</p>"]
    rows = [(i, f"http://h/{i} z", h, "t") for i, h in enumerate(html)] + [(None, None, "<p>é</p>", "t"), (5, "u", html[5], "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(3)
    got = sorted(map(tuple, archives.archive_pages(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    last = {}
    for i, _, h, _ in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    wanted = []
    for i, _, h, _ in rows:
        payload, top = (h or "").encode(), last[h or ""]
        again = (-1 if i is None else i) < top
        wanted.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if again else "response", top if again else None))
    assert got == sorted(wanted, key=str)
    assert archives.archive_pages(pages.limit(0)).collect() == []


def test_arc_versions_and_broken_lengths():
    for version in "12":
        block = b"HTTP/1.1 200 OK\r\nX-Page-Id: 3\r\n\r\nbody"
        data = archives.arc_version_block(version) + b"\n" + archives.arc_header(version, "http://a", "20010203040506", "text/html", len(block)) + block + b"\n"
        (record,) = archives.arc_records(io.BufferedReader(io.BytesIO(data)))
        assert (record.url, record.date, record.block) == ("http://a", "20010203040506", block)
        with pytest.raises(ValueError):
            list(archives.arc_records(io.BufferedReader(io.BytesIO(data[:-10]))))
    with pytest.raises(ValueError):
        list(archives.arc_records(io.BytesIO(b"one two\n")))


def test_languages(spark, sf):
    docs, pages = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "pages"))
    found = langid.identify_documents(docs).withColumnRenamed("lang", "found").join(docs, "doc_id")
    assert found.count() == docs.count() and found.where("found = lang").count() >= 0.98 * docs.count()
    assert langid.identify_pages(pages, docs).where("lang = declared").count() >= 0.95 * pages.count()


def test_evidence_decides_where_text_is_silent(spark):
    docs = spark.createDataFrame([(i, "aaa bbb aab " * 5, "xx") if i % 2 else (i, "ccc ddd ccd " * 5, "yy") for i in range(40)], "doc_id long, text string, lang string")
    rows = [(i, f"http://a.host.q/{i}", "<html lang='xx'><p>aaa bbb aab aaa bbb</p>") for i in range(30)] + [(i, f"http://b.other.w/{i}", "<html lang='yy'><p>ccc ddd ccd</p>") for i in range(30, 70)]
    rows += [(100, "http://a.host.q/n", ""), (101, "http://new.z/", "<html lang=xx><p>1</p>"), (102, None, None), (102, None, None)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, lang string")
    got = {r.page_id: r for r in langid.identify_pages(pages, docs).collect()}
    assert (got[100].lang, got[101].lang, got[102].lang) == ("xx", "xx", "yy") and len(got) == 73
    assert langid.identify_pages(pages.limit(0), docs).collect() == []
    assert {r.lang for r in langid.identify_pages(pages, docs.limit(0)).collect()} == {None}


def test_declaration_is_read_wherever_it_stands(spark):
    page = "<html class='a' lang='xx'><p>1</p>"
    before = {
        1: "<!-- " + "licence - " * 1000 + "<html lang=yy> -->", 2: " " * 9000, 3: "<SCRIPT>" + "if (a < b) c = '<html lang=yy>'; " * 9000 + "</Script >",
        4: "<!--[if gt IE 8]><!-->", 5: "<!--><!---><style>a > b {}</style>",
    }
    pages = [(i, "http://a.q/", x + page) for i, x in before.items()] + [(6, "http://a.q/", "<!-- " + page), (7, "http://a.q/", "<script>" + page), (8, "http://a.q/", None)]
    docs = spark.createDataFrame([(i, "aaa bbb " * 5, "xx") for i in range(9)], "doc_id long, text string, lang string")
    got = langid.identify_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()
    assert {r.page_id: r.declared for r in got} == {**dict.fromkeys(before, "xx"), 6: None, 7: None, 8: None}


def test_pipeline_stages(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == [*docs.columns, "size", "source_size", "target", "taken"] and 0 < out.count() < docs.count()
    assert out.count() == out.select("doc_id").distinct().count() and out.where("taken > 3 * size").count() == 0


def test_queries_are_registered():
    names = entry_points.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
