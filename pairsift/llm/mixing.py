"""Mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairsift.llm.common import kept, whole_text
from pairsift.stages import discarded

# An example of topics: the first rule that a text meets names its topic. A corpus has
# rules of its own, or a column with a classifier's topics.
TOPICS = (
    ("contact", r"[A-Za-z0-9]@[A-Za-z0-9]|[0-9]{3}-[0-9]{4}|[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
    ("legal", r"[Ll]icensed under|License,|[Cc]opyright"),
    ("table", r" \| "),
    ("list", r"\n.*\n.*\n"),
)
OTHER_TOPIC = "prose"
UNKNOWN = "?"
HASH_DIGITS = 13

# Shares are tokens raised to these powers: 1 keeps a marginal, 0 makes it even.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}


def tokens(text: Column) -> Column:
    """Words between ASCII white space; every text counts as one token at least."""
    return F.greatest(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(1)).cast("long")


def topic_of(text: Column, rules: Sequence[tuple[str, str]] = TOPICS) -> Column:
    topic = F.lit(OTHER_TOPIC)
    for name, pattern in reversed(rules):
        topic = F.when(text.rlike(pattern), F.lit(name)).otherwise(topic)
    return topic


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) that only the key and the seed decide."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key))
    number = F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double")
    return number / float(16**HASH_DIGITS)


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """``dimension, target``: tokens to a power, in proportion."""
    return cells.groupBy(dimension).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("target"))


def total(df: DataFrame, column: str) -> float:
    """One number, the sum of a column."""
    return float(df.agg(F.sum(column)).first()[0] or 0.0)


def rake(
    cells: DataFrame, targets: Mapping[str, DataFrame], share: float, sweeps: int = 12
) -> DataFrame:
    """``cells`` (dimensions, ``tokens``) with the ``wanted`` tokens of each cell.

    Starts from ``share`` of every cell and scales to one marginal after another,
    ``sweeps`` times. ``targets`` holds ``category, target`` for each dimension; only
    the proportions of the targets count. No cell can give more tokens than it has;
    what it lacks, others of the same marginal give in later sweeps. Targets that the
    cells cannot meet together leave the last dimension closest to its own. A category
    without a target gives nothing, a target of a category without tokens asks for
    nothing. Cells may be many, so they stay a table (one row for each source,
    language and topic that occur together, however many documents there are). A step
    sums them up by category, which starts in each task, and joins the sums back, so a
    topic that most cells have is no task of its own; its result is stored. One number
    per dimension comes to the driver.
    """
    everything = total(cells, "tokens") * share
    now = cells.withColumn("wanted", F.col("tokens") * F.lit(float(share)))
    for name, target in targets.items():
        present = target.join(cells.select(name).distinct(), name)
        scale = everything / (total(present, "target") or 1.0)
        now = now.join(present.select(name, (F.col("target") * scale).alias(f"goal_{name}")), name, "left")
    now = kept(now, "raked")
    for name in [name for _ in range(sweeps) for name in targets]:
        sums = now.groupBy(name).agg(F.sum("wanted").alias("sum"))
        factor = F.when(F.col("sum") > 0, F.col(f"goal_{name}") / F.col("sum"))
        scaled = F.col("wanted") * F.coalesce(factor, F.lit(0.0))
        last, columns = now, now.columns
        now = now.join(sums, name).withColumn("wanted", F.least(F.col("tokens").cast("double"), scaled))
        now = kept(now.select(*columns), "raked")
        discarded(last)
    return now.select(*targets, "tokens", "wanted")


def record_key(doc_id: str, text: str) -> Column:
    """What a row is drawn by: its id, or the digest of its text if it has none."""
    return F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text "), F.md5(whole_text(text))))


def draws(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    share: float = 0.5,
    seed: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    topics: Sequence[tuple[str, str]] = TOPICS,
    topic: str | None = None,
) -> DataFrame:
    """The result of :func:`mix` with the ``key`` that each row was drawn by."""
    body = whole_text(text)
    rows = kept(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            F.coalesce(F.col("source").cast("string"), F.lit(UNKNOWN)).alias("source"),
            F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
            topic_of(body, topics).alias("topic")
            if topic is None
            else F.coalesce(F.col(topic).cast("string"), F.lit(UNKNOWN)).alias("topic"),
            tokens(body).alias("n_tokens"),
            record_key(doc_id, text).alias("key"),
        ),
        "mixing_rows",
    )
    names = list(POWERS)
    cells = kept(rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "cells")
    goals = {}
    for name in names:
        given = (targets or {}).get(name)
        if given is None:
            goals[name] = tempered(cells, name, POWERS[name])
        else:
            goals[name] = docs.sparkSession.createDataFrame(
                list(given.items()), f"{name} string, target double"
            )
    raked = rake(cells, goals, share)
    discarded(cells)
    chances = raked.select(*names, (F.col("wanted") / F.col("tokens")).alias("probability"))
    # A source may own a third of the rows: a plain join, which adaptive execution
    # turns into a broadcast where the cells are few, and else splits.
    return rows.join(chances, names).select(
        "doc_id", "key", *names, "n_tokens",
        F.round("probability", 6).alias("probability"),
        (uniform(F.col("key"), seed) < F.col("probability")).alias("sampled"),
    )


def mix(docs: DataFrame, *args, **options) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens, probability, sampled`` of every row.

    Tokens per source, language and topic are raked to the ``targets`` (shares by
    dimension and category; where none are given, the shares found, tempered by
    :data:`POWERS`) for ``share`` of all tokens. A cell's wanted tokens divided by its
    tokens are the probability of its documents, and a document is sampled if a hash
    of its id and the seed lies below that, so the same ids are drawn whatever the
    partitioning, and repeated rows alike. A row without an id is drawn by a hash of
    its text. A null source or language is the category ``?``; a null text is empty
    and counts one token. An empty table gives an empty result. ``topics`` are rules of
    the caller (name and pattern, the first that a text meets counts; the built-in four
    are an example), or ``topic`` names a column that has the topics, null being ``?``.
    The arguments are those of :func:`draws`.
    """
    return draws(docs, *args, **options).drop("key")


def sampled_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that :func:`mix` samples, all columns.

    Rows that repeat are sampled alike; nulls, empty texts and an empty table as there.
    """
    drawn = draws(docs, doc_id=doc_id, text=text, **options).where("sampled")
    keys = drawn.select(F.col("key").alias("_key")).distinct()
    rows = docs.select(record_key(doc_id, text).alias("_key"), F.struct("*").alias("_row"))
    return rows.join(keys, "_key", "left_semi").select("_row.*")
