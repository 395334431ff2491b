"""Command line: ``spark-submit job.py <unigrams> <bigrams> <output> <files>``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from pairsift.operators.metrics import Metrics
from pairsift.plans.collocations import UNCOUNTED, collocations
from pairsift.sources.ngrams import read_lines, read_sequence
from pairsift.sources.results import write_results
from pairsift.sources.stopwords import read_words
from pairsift.stages import complete, removed

# Lets adaptive execution join by hashing where every partition of a looked-up
# table is this small, which saves sorting the pairs. Other partitions are sorted.
SETTINGS = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB"}


def with_settings(spark: SparkSession) -> SparkSession:
    """The session, with :data:`SETTINGS` where it has none of its own."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark


def session() -> SparkSession:
    """A session with :data:`SETTINGS`."""
    return with_settings(SparkSession.builder.appName("pairsift").getOrCreate())


def same_inputs(spark: SparkSession, folder: str, inputs: list[str]) -> None:
    """Notes in a stage folder what it is made of; an error if it was something else."""
    note = f"{folder}/inputs"
    if complete(spark, note):
        before = [row.value for row in spark.read.text(note).orderBy("value").collect()]
        if before != sorted(inputs):
            raise ValueError(f"{folder} holds stages of other inputs: {before}")
    else:
        spark.createDataFrame([(x,) for x in inputs], "value string").coalesce(1).write.mode("overwrite").text(note)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("unigrams", help="folder or files of unigram lines")
    parser.add_argument("bigrams", help="folder or files of bigram lines")
    parser.add_argument("output", help="folder for the result lines; replaced")
    parser.add_argument("files", type=int, help="number of result files")
    # Scripts that pass a fifth argument go on working.
    parser.add_argument("combiner", nargs="?", help="ignored: Spark always sums before it shuffles")
    parser.add_argument("-k", type=int, default=100, help="pairs per decade")
    parser.add_argument("--format", choices=["sequence", "text"], default="sequence")
    parser.add_argument(
        "--stage-dir", help="folder for the stage tables, which stay; default: beside the output, until it is written"
    )
    parser.add_argument("--resume", action="store_true", help="start from the complete stages of the same inputs")
    parser.add_argument("--stopwords", help="file of stop words, one a line, in place of the built-in ones")
    parser.add_argument("--report", action="store_true", help="print the rows of every step, counted on the way")
    parser.add_argument("--buckets", type=int, help="lay stages out in so many buckets of the joins' columns")
    options = parser.parse_args(args)

    spark = session()
    read = read_sequence if options.format == "sequence" else read_lines
    stage_dir = options.stage_dir or f"{options.output.rstrip('/')}_stages"
    if not options.resume:
        removed(spark, f"{stage_dir}/inputs")
    same_inputs(spark, stage_dir, [f"unigrams {options.unigrams}", f"bigrams {options.bigrams}", options.format])
    metrics = Metrics() if options.report else UNCOUNTED
    ranked = collocations(
        read(spark, options.unigrams),
        read(spark, options.bigrams),
        options.k,
        stopwords=read_words(spark, options.stopwords) if options.stopwords else None,
        stage_dir=stage_dir,
        resume=options.resume,
        buckets=options.buckets,
        paths=([options.unigrams], [options.bigrams]),
        metrics=metrics,
    )
    write_results(ranked, options.output, options.files)
    if options.report:
        metrics.taken()
        metrics.funnel(spark).show(truncate=False)
    if not options.stage_dir:
        removed(spark, stage_dir)


if __name__ == "__main__":
    main()
