"""The pipeline on small hostile tables."""

import pytest

import corpus_pipeline
from tidemark.llm import decontam, mixing, neardup, secretscan, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, item_id string, taken_from string"
LONG = "plain words about the river and the mill " * 3000


def written(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i % 2 == 0)) for i in range(40)] + [(None, 1, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, "the quick benchmark question that nobody should ever train on because it is held out"), (2, None), (None, "x"), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def doc(i, text, source="a"):
    return (i, text, "en", source, len(text or ""), "l", "i", "t")


@pytest.fixture
def rows():
    kind = [doc(i, f"{'zorg blix' if i % 2 == 0 else 'fine day'} number {i} " + " ".join(f"w{i}x{k}" for k in range(12))) for i in range(40)]
    odd = [
        doc(100, None), doc(101, ""), doc(102, " \n\t"), doc(None, "a row without an id", None), doc(None, None, None), doc(103, LONG), doc(104, LONG),
        doc(105, "say the quick benchmark question that nobody should ever train on because it is held out now"), doc(106, "one two three four five six seven", None),
        doc(106, "one two three four five six seven", None), doc(107, "password = hunter2secret and more words here to keep"),
    ]
    return kind + odd


def test_every_stage_keeps_nulls_long_texts_and_other_columns(spark, tmp_path, rows):
    folder = written(spark, tmp_path, rows)
    docs, columns, kept = spark.read.parquet(f"{folder}/documents.parquet"), [c.split()[0] for c in SCHEMA.split(", ")], {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
        assert docs.columns[: len(columns)] == columns
        kept[name] = [r.asDict() for r in docs.collect()]
    # forty labels teach little about new wording: only texts like the ordinary ones, and rows without evidence, are sure to stay
    assert {r["doc_id"] for r in kept["toxicity"]} >= {*range(1, 40, 2), 100, 101, 102, None}
    near = [r["doc_id"] for r in kept["near-duplicates"]]
    assert 104 not in near and near.count(106) <= 1 and near.count(None) == 2
    assert 105 not in {r["doc_id"] for r in kept["decontamination"]} and {100, 101, 102} <= {r["doc_id"] for r in kept["decontamination"]}
    texts = {r["doc_id"]: r["text"] for r in kept["secrets"]}
    assert "hunter2secret" not in texts.get(107, "") and texts.get(103, LONG) == LONG and texts[100] is None
    assert all(0 < r["taken"] <= 3 * r["size"] for r in kept["mixing"])


def test_empty_tables(spark, tmp_path):
    folder = written(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_stages_equal_the_operators(spark, tmp_path, rows):
    """Each stage keeps the rows its operator's table says."""
    folder = written(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda x: (x is not None, x))
    assert ids(corpus_pipeline.drop_toxic(spark, docs, folder)) == ids(toxicity.toxicity_scores(docs, labels).where("predicted = 0"))
    named = docs.where("doc_id IS NOT NULL")
    assert ids(corpus_pipeline.drop_near_duplicates(spark, named, folder)) == ids(neardup.near_duplicates(named).where("kept"))
    held = {r.doc_id for r in decontam.contaminated(docs, items).collect()}
    assert held == {105} and ids(corpus_pipeline.drop_benchmark(spark, named, folder)) == [i for i in ids(named) if i not in held]
    assert ids(corpus_pipeline.redact_secrets(spark, docs, folder)) == ids(docs)
    assert secretscan.secret_spans(docs).where("n_assign > 0").select("doc_id").collect()[0][0] == 107
    assert ids(corpus_pipeline.mix_sources(spark, docs, folder)) == ids(mixing.mixed_by_source(docs).where("taken > 0"))
