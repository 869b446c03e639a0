import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.session import ARROW_BYTES_CONF, arrow_batches, materialize


def test_rows_reach_python_in_batches_of_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    rows = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("t"))
    with arrow_batches(spark, 1 << 20):
        most = [r.n for r in materialize(rows.mapInArrow(sizes, "n long"), "sizes").collect()]
    assert sum(most) == 2000 and max(most) <= (1 << 20) / 2000
    assert spark.conf.get(ARROW_BYTES_CONF, None) is None
    spark.conf.set(ARROW_BYTES_CONF, "5m")
    try:
        with arrow_batches(spark, 1 << 20):
            assert spark.conf.get(ARROW_BYTES_CONF) == "5m"
        assert spark.conf.get(ARROW_BYTES_CONF) == "5m"
    finally:
        spark.conf.unset(ARROW_BYTES_CONF)


def test_stored_files_hold_few_rows(spark):
    kept = materialize(spark.range(0, 20, 1, 1), "few", file_rows=3)
    assert kept.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] == 3
    assert kept.count() == 20
