"""Hadoop SequenceFiles (``LongWritable`` id, ``Text`` line), read and written in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LONG_WRITABLE = "org.apache.hadoop.io.LongWritable"
TEXT_WRITABLE = "org.apache.hadoop.io.Text"
OUTPUT = "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat"
COMPRESS = "mapreduce.output.fileoutputformat.compress"


def read_sequence(spark: SparkSession, path: str) -> DataFrame:
    """Lines of SequenceFiles as one ``value`` column.

    Splits are read in parallel by the JVM, which takes each ``Text`` apart into its
    buffer and the length in use; no line passes through Python.
    """
    jvm, java_session = spark._jvm, spark._jsparkSession
    classes = [jvm.java.lang.Class.forName(name) for name in (LONG_WRITABLE, TEXT_WRITABLE)]
    texts = spark.sparkContext._jsc.sequenceFile(path, *classes).values()
    buffers = DataFrame(java_session.createDataFrame(texts, classes[1]), spark)
    line = F.substring("bytes", F.lit(1), F.col("length"))
    return buffers.select(F.decode(line, "UTF-8").alias("value"))


def write_sequence(lines: DataFrame, path: str, codec: str | None = None) -> None:
    """The ``value`` lines as SequenceFiles, one per partition; a null line is an empty one.

    ``path`` must not exist. ``codec`` names a Hadoop codec class, with which blocks of
    records are compressed. Rows become pairs of a number and a text by an encoder, and
    these Writables by the converter that Spark's own savers use, so no line passes
    through Python. Tasks write to the committer's folder, which a lost executor leaves
    unharmed.
    """
    spark = lines.sparkSession
    jvm = spark._jvm
    encoders = jvm.org.apache.spark.sql.Encoders
    numbered = lines.select(
        F.monotonically_increasing_id().alias("_1"), F.coalesce("value", F.lit("")).alias("_2")
    )
    pairs = getattr(numbered._jdf, "as")(encoders.tuple(encoders.LONG(), encoders.STRING())).rdd()
    python = jvm.org.apache.spark.api.python
    converter = python.JavaToWritableConverter()
    written = python.PythonHadoopUtil.convertRDD(pairs, converter, converter)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    conf.set(COMPRESS, "false" if codec is None else "true")
    if codec is not None:
        conf.set(f"{COMPRESS}.codec", codec)
        conf.set(f"{COMPRESS}.type", "BLOCK")
    classes = [jvm.java.lang.Class.forName(name) for name in (LONG_WRITABLE, TEXT_WRITABLE, OUTPUT)]
    rows = jvm.org.apache.spark.api.java.JavaPairRDD.fromJavaRDD(written.toJavaRDD())
    rows.saveAsNewAPIHadoopFile(path, *classes, conf)


def escaped(text: Column) -> Column:
    """A text without the characters that end fields and lines, each told by a letter after ``\\``."""
    for character, name in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n")):
        text = F.replace(text, F.lit(character), F.lit(name))
    return text


def write_table(df: DataFrame, path: str, codec: str | None = None) -> None:
    """Rows as lines of tab-separated fields in SequenceFiles, for stages that other programs read.

    A null is ``\\N``; backslashes, tabs and line feeds in texts are escaped. Columns are
    numbers and texts; dates and the like are written as Spark prints them.
    """
    fields = [F.coalesce(escaped(F.col(name).cast("string")), F.lit("\\N")) for name in df.columns]
    write_sequence(df.select(F.concat_ws("\t", *fields).alias("value")), path, codec)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows that :func:`write_table` wrote, with a schema like ``"decade int, w string"``."""
    like = spark.createDataFrame([], schema).schema
    fields = F.split("value", "\t", -1)

    def value(at: int) -> Column:
        raw = F.get(fields, F.lit(at))
        # A backslash that is one is put out of the way while the other escapes are undone.
        plain = F.replace(raw, F.lit("\\\\"), F.lit("\t"))
        for name, character in (("\\t", "\0"), ("\\n", "\n"), ("\t", "\\"), ("\0", "\t")):
            plain = F.replace(plain, F.lit(name), F.lit(character))
        return F.when(raw != "\\N", plain)

    columns = [value(i).cast(field.dataType).alias(field.name) for i, field in enumerate(like)]
    return read_sequence(spark, path).select(*columns)
