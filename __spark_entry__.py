"""The driver's way in: the flagship query, all queries, and their SQL twins."""

from __future__ import annotations

import sys
import warnings
from collections.abc import Callable
from functools import cached_property, reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle_queries  # noqa: E402
from pairsift import slices  # noqa: E402
from pairsift.functions.text import clean_token, decade_of  # noqa: E402
from pairsift.manifests import files_of  # noqa: E402
from pairsift.operators import cleaning, counts, filters, joins, ranking, scoring, stats  # noqa: E402
from pairsift.operators.metrics import Metrics  # noqa: E402
from pairsift.plans import collocations as plan  # noqa: E402
from pairsift.plans import job  # noqa: E402
from pairsift.sources import corpus, ngrams, ranges, results, sequence, stopwords  # noqa: E402
from pairsift.stages import new_folder, removed, staged  # noqa: E402
from pairsift.sums import StoredSums  # noqa: E402

try:  # the subpackage for training data and its pipeline can be taken out
    import corpus_pipeline
    from pairsift.llm import queries as llm_queries
except ImportError as missing:
    # Also without a package that only they need; the other queries work either way.
    if missing.name not in ("corpus_pipeline", "pairsift.llm"):
        warnings.warn(f"no queries for training data: {missing}", stacklevel=2)
    llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

DECIMALS = 4
TOP_FEW = 10
MANY = 5000
OWN_STOP_WORDS = 50


class Tables:
    """The driver's tables of one scale and the n-gram lines made of them.

    With ``part`` only the texts of some decades, whose folders go to ``scratch``.
    """

    def __init__(self, spark: SparkSession, folder: str, part: slices.Slice = slices.WHOLE, scratch: str | None = None):
        self.spark, self.folder = job.with_settings(spark), folder
        self.part, self.scratch = part, scratch

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def texts(self, table: DataFrame, id_column: str) -> DataFrame:
        return self.part.rows(corpus.texts(table, id_column))

    def new_folder(self, name: str) -> str:
        return f"{self.scratch}/{name}" if self.scratch else new_folder(self.spark, name)

    @cached_property
    def parts(self) -> list[slices.Slice]:
        """The decades of the documents in slices; a small table is one."""
        size = sum(file[1] for file in files_of(self.spark, [f"{self.folder}/documents.parquet"]))
        if self.part != slices.WHOLE or size <= slices.SLICE_BYTES:
            return [self.part]
        decades = self.documents.groupBy(decade_of(F.col("year")).alias("decade")).count()
        return slices.slices_of(dict(map(tuple, decades.collect())), size, slices.SLICE_BYTES)

    @cached_property
    def documents(self) -> DataFrame:
        return self.texts(self.table("documents"), "doc_id")

    def unigram_lines(self) -> DataFrame:
        return corpus.unigram_lines(self.documents)

    def bigram_lines(self) -> DataFrame:
        return corpus.bigram_lines(self.documents)

    def unigrams(self) -> DataFrame:
        return plan.counted_words(self.unigram_lines())

    def clean_bigrams(self) -> DataFrame:
        return cleaning.clean_bigrams(
            ngrams.split_bigrams(ngrams.parse_ngrams(self.bigram_lines()))
        )

    def pairs(self) -> DataFrame:
        return plan.counted_pairs(self.bigram_lines())

    def joined(self) -> DataFrame:
        """Pairs with both word counts and the decade total."""
        return by_decades(self, "joined", lambda t: plan.joined_pairs(t.unigrams(), t.pairs()))

    def scored(self) -> DataFrame:
        return rounded(scoring.with_score(self.joined()), "score")


def by_decades(t: Tables, name: str, rows: Callable[[Tables], DataFrame]) -> DataFrame:
    """The ``rows`` of all decades; those of a large table are made and stored slice by slice."""
    if len(t.parts) == 1:
        return rows(t)
    folder = new_folder(t.spark, name)

    def maker(number: int, part: slices.Slice) -> Callable[[], DataFrame]:
        # What an earlier slice has kept for its rows is not needed any more.
        def make() -> DataFrame:
            removed(t.spark, f"{folder}/scratch/{number - 1}")
            return rows(Tables(t.spark, t.folder, part, f"{folder}/scratch/{number}"))

        return make

    made = slices.in_turn(t.spark, f"{folder}/rows", [maker(*part) for part in enumerate(t.parts)])
    removed(t.spark, f"{folder}/scratch")
    return made


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Two engines agree on a logarithm up to its last digits only."""
    return df.withColumns({name: F.round(name, DECIMALS) for name in names})


def decade_bucket(t: Tables) -> DataFrame:
    lines = ngrams.parse_ngrams(t.bigram_lines())
    return lines.groupBy(decade_of(F.col("year")).alias("decade")).agg(
        F.count("*").alias("lines"), F.sum("cnt").alias("cnt")
    )


def clean_tokens(t: Tables) -> DataFrame:
    raw = t.documents.select(F.explode_outer("tokens").alias("raw"))
    return raw.where("raw != ''").distinct().select("raw", clean_token(F.col("raw")).alias("token"))


def stopwords_dim(t: Tables) -> DataFrame:
    """How often each stop word occurs in the texts."""
    listed = stopwords.stopword_table(t.spark)
    # Only the stop words' counts are wanted; the inner join drops the others
    # before anything is summed over decades.
    found = t.unigrams().join(listed.select("w").distinct(), "w")
    total = found.groupBy("w").agg(F.sum("c").alias("c"))
    return listed.join(total, "w", "left").select("w", "lang", F.coalesce("c", F.lit(0)).alias("c"))


def logl_terms(t: Tables) -> DataFrame:
    terms = scoring.with_terms(t.joined())
    return rounded(terms, *terms.columns[3:])


def other_corpus(t: Tables) -> DataFrame:
    """Pairs of the documents, words counted in the conversations.

    Many words are unknown there or rarer than the pair, so that every odd case
    of the score comes up.
    """
    talks = corpus.texts(t.table("conversations"), "conv_id")
    spoken = plan.counted_words(corpus.unigram_lines(talks))
    score = scoring.g2(*map(F.col, scoring.COUNTS))
    return rounded(plan.joined_pairs(spoken, t.pairs()).withColumn("score", score), "score")


def products_top(t: Tables) -> DataFrame:
    """Top pairs of the two-word product names, weighted by the quantity sold."""
    words, names = corpus.product_lines(t.table("lineitem"), t.table("part"))
    return plan.collocations(words, names, decimals=DECIMALS)


def pages_top(t: Tables) -> DataFrame:
    """Top pairs of raw web pages, whose tokens are full of markup."""
    pages = t.table("pages").select("page_id", F.col("html").alias("text"))
    texts = corpus.texts(pages, "page_id")
    return plan.collocations(corpus.unigram_lines(texts), corpus.bigram_lines(texts), decimals=DECIMALS)


def documents_top(t: Tables, k: int = 100) -> DataFrame:
    def top(part: Tables) -> DataFrame:
        return plan.collocations(part.unigram_lines(), part.bigram_lines(), k, decimals=DECIMALS)

    return by_decades(t, "top", top)


def ranked(t: Tables) -> DataFrame:
    """All pairs with their rank; a slice is ranked after the other, as that runs at once."""
    with slices.shuffles_dropped(t.spark):
        parts = [ranking.rank_per_decade(Tables(t.spark, t.folder, part).scored()) for part in t.parts]
    return reduce(DataFrame.unionByName, parts)


def scored_top(t: Tables, k: int) -> DataFrame:
    return by_decades(t, "top", lambda part: ranking.topk_per_decade(part.scored(), k))


def from_text_files(t: Tables) -> DataFrame:
    """Line files in, ranked pairs out, with all stages stored."""
    folder = new_folder(t.spark, "text")
    t.unigram_lines().write.text(f"{folder}/unigrams")
    t.bigram_lines().write.text(f"{folder}/bigrams")
    return plan.collocations(
        ngrams.read_lines(t.spark, f"{folder}/unigrams"),
        ngrams.read_lines(t.spark, f"{folder}/bigrams"),
        stage_dir=f"{folder}/stages",
        decimals=DECIMALS,
    )


def from_buckets(t: Tables) -> DataFrame:
    """The same from stages that an earlier run has left in buckets, none of which is made again."""
    folder = new_folder(t.spark, "buckets")
    t.unigram_lines().write.text(f"{folder}/unigrams")
    t.bigram_lines().write.text(f"{folder}/bigrams")

    def run(resume: bool) -> DataFrame:
        return plan.collocations(
            ngrams.read_lines(t.spark, f"{folder}/unigrams"),
            ngrams.read_lines(t.spark, f"{folder}/bigrams"),
            stage_dir=f"{folder}/stages",
            buckets=int(t.spark.conf.get("spark.sql.shuffle.partitions")),
            resume=resume,
            decimals=DECIMALS,
        )

    run(False)
    return run(True)


def from_sequence_files(t: Tables) -> DataFrame:
    """The same from SequenceFiles."""

    def top(part: Tables) -> DataFrame:
        folder = part.new_folder("sequence")
        for name, lines in (("unigrams", part.unigram_lines()), ("bigrams", part.bigram_lines())):
            # Stored before: what the lines were shuffled for would stay beside the files.
            corpus.write_sequence(staged(lines, f"{folder}/lines"), f"{folder}/{name}")
            removed(t.spark, f"{folder}/lines")
        return plan.collocations(
            ngrams.read_sequence(t.spark, f"{folder}/unigrams"),
            ngrams.read_sequence(t.spark, f"{folder}/bigrams"),
            decimals=DECIMALS,
        )

    return by_decades(t, "top", top)


def from_filtered_words(t: Tables) -> DataFrame:
    """The same with word counts that pass a filter of the pairs' words, in stored stages."""
    return plan.collocations(
        t.unigram_lines(),
        t.bigram_lines(),
        stage_dir=new_folder(t.spark, "filtered"),
        decimals=DECIMALS,
        word_filter=filters.BITS,
    )


def bounded_top(t: Tables, k: int) -> DataFrame:
    """The best pairs out of a stored table, most of which a bound drops before the sort."""

    def best(part: Tables) -> DataFrame:
        return ranking.topk_of_stored(staged(part.scored(), part.new_folder("scored")), k)

    return by_decades(t, "top", best)


def checked_results(t: Tables) -> DataFrame:
    """Result lines, each once as it is and once for each way in which it can be wrong."""
    folder = new_folder(t.spark, "damaged")
    top = documents_top(t).withColumn("score", F.col("score").cast(f"decimal(24,{DECIMALS})"))
    fields = "concat_ws('\t', decade, {score}, {pair})"
    whole = fields.format(score="score", pair="concat(w1, ',', w2)")
    kinds = [
        whole,
        f"replace({whole}, '\t', ' ')",
        f"concat('  ', {whole})",
        fields.format(score="'n/a'", pair="concat(w1, ',', w2)"),
        fields.format(score="score", pair="concat(w1, ' ', w2)"),
        fields.format(score="score", pair="concat(w1, '9', w2, ',', w2)"),
    ]
    top.select(F.explode(F.array(*map(F.expr, kinds))).alias("value")).write.text(folder)
    return rounded(results.read_results_checked(t.spark, folder).drop("file"), "score")


def looked_up(t: Tables) -> DataFrame:
    """The pairs of the most frequent first words, out of files in key order."""
    folder = new_folder(t.spark, "ranges")
    pairs = staged(t.pairs(), f"{folder}/pairs")
    ranges.write_ranges(pairs, f"{folder}/ordered", 24)
    frequent = pairs.groupBy("w1").agg(F.sum("c12").alias("c")).orderBy(F.desc("c"), "w1").limit(TOP_FEW)
    return ranges.pairs_of(t.spark, f"{folder}/ordered", [row["w1"] for row in frequent.collect()])


def loaded_twice(t: Tables) -> DataFrame:
    """Pair counts of two loads, the second of which brings files of the first along."""
    folder, schema = new_folder(t.spark, "sums"), "decade int, w1 string, w2 string, c12 bigint"
    table = t.table("documents")
    for half in (0, 1):
        texts = corpus.texts(table.where(F.pmod(F.xxhash64("text"), F.lit(2)) == half), "doc_id")
        corpus.bigram_lines(texts).write.text(f"{folder}/lines/{half}")
    sums = StoredSums(t.spark, f"{folder}/sums", ["decade", "w1", "w2"], "c12")
    for paths in ([f"{folder}/lines/0"], [f"{folder}/lines/0", f"{folder}/lines/1"]):
        sums.load(paths, lambda names: plan.counted_pairs(t.spark.read.text(names)), schema)
    return sums.rows(schema)


def sequence_stage(t: Tables) -> DataFrame:
    """Pair counts as another program gets them: out of SequenceFiles."""
    folder = new_folder(t.spark, "sequence_stage")
    sequence.write_table(t.pairs(), folder, codec="org.apache.hadoop.io.compress.DefaultCodec")
    return sequence.read_table(t.spark, folder, "decade int, w1 string, w2 string, c12 bigint")


def result_files(t: Tables) -> DataFrame:
    """The ranked pairs as they come back from result files written twice."""
    folder = new_folder(t.spark, "results")
    results.write_results(documents_top(t, TOP_FEW), folder, 3)
    results.write_results(documents_top(t), folder, 2)
    return rounded(results.read_results(t.spark, folder), "score")


def hebrew_lines(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Lines of the documents in Hebrew letters, and some lines of real Hebrew."""
    text = F.translate(F.lower("text"), corpus.LATIN, corpus.HEBREW)
    texts = t.texts(t.table("documents").select("doc_id", text.alias("text")), "doc_id")

    def and_lines(lines: DataFrame, more: list[tuple]) -> DataFrame:
        rows = [("\t".join(map(str, row)), row[1]) for row in more]
        return lines.unionByName(t.part.rows(t.spark.createDataFrame(rows, "value string, year int")).select("value"))

    return (
        and_lines(corpus.unigram_lines(texts), corpus.HEBREW_UNIGRAMS),
        and_lines(corpus.bigram_lines(texts), corpus.HEBREW_BIGRAMS),
    )


def hebrew_top(t: Tables) -> DataFrame:
    return by_decades(t, "top", lambda part: plan.collocations(*hebrew_lines(part), decimals=DECIMALS))


def token_edges(t: Tables) -> DataFrame:
    """Tokens of the documents with signs around them, and some odd tokens."""
    raw = t.documents.select(F.explode_outer("tokens").alias("raw")).where("raw != ''").distinct()
    dressed = raw.select(F.explode(F.array(*map(F.expr, corpus.DRESSED))).alias("raw"))
    odd = t.spark.createDataFrame([(token,) for token in corpus.ODD_TOKENS], "raw string")
    every = dressed.unionByName(odd).distinct()
    return every.select("raw", clean_token(F.col("raw")).alias("token"))


def own_stopwords(t: Tables) -> DataFrame:
    """Pair counts without the most frequent words, which come as a table in upper case."""
    frequent = t.unigrams().groupBy("w").agg(F.sum("c").alias("c"))
    frequent = frequent.orderBy(F.desc("c"), "w").limit(OWN_STOP_WORDS)
    return plan.counted_pairs(t.bigram_lines(), frequent.select(F.upper("w").alias("w")))


def mixed_lines(t: Tables) -> DataFrame:
    """Lines of all kinds, most of which break some rule."""
    part, orders = t.table("part"), t.table("orders")

    def line(*fields: str) -> Column:
        return F.concat_ws("\t", *(F.expr(f) for f in fields)).alias("value")

    prose = F.explode_outer(F.split("text", "\n")).alias("value")
    return (
        t.bigram_lines()
        .unionByName(t.table("documents").select(prose))
        .unionByName(part.select(line("p_name", "p_brand", "p_size")))
        .unionByName(part.select(line("p_name", "'1995'", "p_retailprice")))
        .unionByName(part.select(line("p_type", "'1995'", "p_size")))
        .unionByName(orders.select(line("o_orderpriority", "' 1995 '", "concat(' +', o_custkey)")))
    )


def rejects(t: Tables) -> DataFrame:
    return stats.rejects_by_reason(
        stats.bigram_outcomes(mixed_lines(t), stopwords.stop_words())
    )


def stage_funnel(t: Tables) -> DataFrame:
    """Rows of every stage, all stages stored like in a run with a stage folder.

    Lines are read once, for the sums and for what became of them.
    """
    keep = plan.keep_in(new_folder(t.spark, "funnel"))
    read = stats.read_unigrams(t.unigram_lines())
    summed_words = keep("unigram_sums", stats.summed_lines(read, ["decade", "w"]))
    unigrams = stats.accepted_sums(summed_words, "c")
    read = stats.read_bigrams(t.bigram_lines(), stopwords.stop_words())
    summed_pairs = keep("bigram_sums", stats.summed_lines(read, ["decade", "w1", "w2"]))
    pairs = stats.accepted_sums(summed_pairs, "c12")
    with_c1 = keep("with_c1", joins.with_word_count(pairs, unigrams, "w1", "c1"))
    with_c2 = keep("with_c2", joins.with_word_count(with_c1, unigrams, "w2", "c2"))
    totals = keep("totals", counts.decade_totals(unigrams))
    scored = keep("scored", scoring.with_score(joins.with_totals(with_c2, totals)))
    top = keep("top", ranking.topk_per_decade(scored))
    return stats.stage_funnel(
        {
            "bigram": (stats.outcomes(summed_pairs), pairs),
            "unigram": (stats.outcomes(summed_words), unigrams),
        },
        {
            "join_c1": (pairs, with_c1),
            "join_c2": (with_c1, with_c2),
            "score": (with_c2, scored),
            "totals": (unigrams, totals),
            "top": (scored, top),
        },
    )


def observed_funnel(t: Tables) -> DataFrame:
    """The same numbers, counted by the jobs of a run that stores its stages and writes its result."""
    folder, metrics = new_folder(t.spark, "observed"), Metrics()
    top = plan.collocations(
        t.unigram_lines(), t.bigram_lines(), stage_dir=f"{folder}/stages", metrics=metrics
    )
    results.write_results(top, f"{folder}/out", 2)
    metrics.taken()
    return metrics.funnel(t.spark)


def output_lines(t: Tables) -> DataFrame:
    top = documents_top(t)
    # The sink prints doubles; engines print them differently, decimals alike.
    fixed = top.withColumn("score", F.col("score").cast(f"decimal(24,{DECIMALS})"))
    return results.result_lines(fixed).withColumnRenamed("value", "line")


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "ngram_parse_unigrams": lambda t: ngrams.parse_ngrams(t.unigram_lines()),
    "ngram_parse_bigrams": lambda t: ngrams.parse_ngrams(t.bigram_lines()),
    "decade_bucket": decade_bucket,
    "bigram_tokens": lambda t: ngrams.split_bigrams(ngrams.parse_ngrams(t.bigram_lines())),
    "clean_token": clean_tokens,
    "unigram_clean": lambda t: cleaning.clean_unigrams(ngrams.parse_ngrams(t.unigram_lines())),
    "bigram_clean": lambda t: t.clean_bigrams(),
    "stopwords_dim": stopwords_dim,
    "bigram_stopword_filter": lambda t: cleaning.without_stopwords(
        t.clean_bigrams(), stopwords.stop_words()
    ),
    "bigram_stopword_antijoin": lambda t: cleaning.without_stopword_rows(
        t.clean_bigrams(), stopwords.stopword_table(t.spark)
    ),
    "bigram_counts": lambda t: t.pairs(),
    "bigram_counts_from_sequence": sequence_stage,
    "bigram_counts_of_two_loads": loaded_twice,
    "pairs_of_frequent_words": looked_up,
    "bigram_counts_sorted": lambda t: counts.in_key_order(t.pairs()),
    "unigram_counts": lambda t: t.unigrams(),
    "decade_totals": lambda t: counts.decade_totals(t.unigrams()),
    "join_c1": lambda t: joins.with_word_count(t.pairs(), t.unigrams(), "w1", "c1"),
    "join_c2": lambda t: t.joined().drop("n"),
    "join_totals": lambda t: t.joined(),
    "logl_terms": logl_terms,
    "llr_score": lambda t: t.scored(),
    "llr_score_other_corpus": other_corpus,
    "rank_per_decade": ranked,
    "topk_per_decade": lambda t: scored_top(t, TOP_FEW),
    "topk_per_decade_5000": lambda t: scored_top(t, MANY),
    "collocations_top100": documents_top,
    "collocations_products": products_top,
    "collocations_pages": pages_top,
    "collocations_from_text": from_text_files,
    "collocations_from_sequence": from_sequence_files,
    "collocations_from_buckets": from_buckets,
    "collocations_filtered_words": from_filtered_words,
    "topk_by_bounds": lambda t: bounded_top(t, TOP_FEW),
    "topk_by_bounds_5000": lambda t: bounded_top(t, MANY),
    "result_files": result_files,
    "result_lines_checked": checked_results,
    "bigram_counts_hebrew": lambda t: plan.counted_pairs(hebrew_lines(t)[1]),
    "collocations_hebrew": hebrew_top,
    "clean_token_edges": token_edges,
    "bigram_counts_own_stopwords": own_stopwords,
    "format_output_lines": output_lines,
    "stage_funnel": stage_funnel,
    "stage_funnel_observed": observed_funnel,
    "rejects_by_reason": rejects,
    "pair_decades": lambda t: stats.pair_decades(documents_top(t)),
    "pair_runs": lambda t: stats.pair_runs(documents_top(t)),
}


def entry(spark: SparkSession) -> DataFrame:
    """The top 100 pairs of each decade."""
    return queries()["collocations_top100"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    def query(run: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, folder: run(Tables(spark, folder))

    found = {name: query(run) for name, run in QUERIES.items()}
    if llm_queries is not None:
        found |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    """SQL for DuckDB; for every query that has no result of Spark's own making."""
    found = oracle_queries.all_sql()
    if llm_queries is not None:
        found |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
