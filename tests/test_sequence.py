"""SequenceFiles written and read without Python."""

import pytest

from pairsift.sources import sequence

SCHEMA = "decade int, w string, c bigint, score double"
ROWS = [
    (1990, "dog", 7, 1.5), (None, None, None, None), (2000, "", -1, float("inf")), (2010, "תל אביב", 2**60, 1e-300),
    (1, "tab\there", 0, 0.0), (2, "line\nfeed \\n \\t \\\\ \\N", 0, 0.0), (3, "\\N", 1, 0.1), (4, "\\", 1, 0.1), (5, "\\\\N", 1, 2.0),
]


@pytest.mark.parametrize("codec", [None, "org.apache.hadoop.io.compress.DefaultCodec"])
def test_table_round_trip(spark, tmp_path, plan_of, codec):
    df = spark.createDataFrame(ROWS, SCHEMA)
    sequence.write_table(df.repartition(3), f"{tmp_path}/t", codec)
    back = sequence.read_table(spark, f"{tmp_path}/t", SCHEMA)
    assert back.schema == df.schema
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(ROWS, key=repr)
    assert "Python" not in plan_of(back)


def test_lines_round_trip(spark, tmp_path):
    rows = [(f"line {i} é 漢 \t x",) for i in range(3000)] + [("",), (None,), ("x" * 100_000,)]
    sequence.write_sequence(spark.createDataFrame(rows, "value string").repartition(4), f"{tmp_path}/s")
    back = [r.value for r in sequence.read_sequence(spark, f"{tmp_path}/s").collect()]
    assert sorted(back) == sorted(value or "" for (value,) in rows)


def test_no_python_worker_writes(spark, tmp_path, monkeypatch):
    """The pairs that are written are the JVM's own rows; no worker could be started."""
    rows = spark.range(1000).selectExpr("concat('w', id) AS value")
    monkeypatch.setattr(type(rows), "rdd", property(lambda self: pytest.fail("rows went to Python")))
    sequence.write_sequence(rows, f"{tmp_path}/s")
    assert sequence.read_sequence(spark, f"{tmp_path}/s").count() == 1000


def test_classes_of_the_files(spark, tmp_path):
    """Other Hadoop programs find a LongWritable and a Text; small numbers are no IntWritable."""
    sequence.write_sequence(spark.createDataFrame([("a",)], "value string").coalesce(1), f"{tmp_path}/s")
    jvm = spark._jvm
    part = next((tmp_path / "s").glob("part-*"))
    option = jvm.org.apache.hadoop.io.SequenceFile.Reader.file(jvm.org.apache.hadoop.fs.Path(str(part)))
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.io.SequenceFile.Reader.Option, 1)
    options[0] = option
    reader = jvm.org.apache.hadoop.io.SequenceFile.Reader(jvm.org.apache.hadoop.conf.Configuration(), options)
    assert (reader.getKeyClassName(), reader.getValueClassName()) == (sequence.LONG_WRITABLE, sequence.TEXT_WRITABLE)
    reader.close()


def test_existing_folder_is_refused(spark, tmp_path):
    rows = spark.createDataFrame([("a",)], "value string")
    sequence.write_sequence(rows, f"{tmp_path}/s")
    with pytest.raises(Exception, match="already exists"):
        sequence.write_sequence(rows, f"{tmp_path}/s")


def test_empty_table(spark, tmp_path):
    sequence.write_table(spark.createDataFrame([], SCHEMA), f"{tmp_path}/e")
    assert sequence.read_table(spark, f"{tmp_path}/e", SCHEMA).collect() == []
