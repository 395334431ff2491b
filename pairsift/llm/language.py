"""Language identification: the family first, then the language within it."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsift.llm.common import kept, whole_text
from pairsift.stages import discarded

# Language families; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk",
    "uralic": "fi et hu",
    "baltic": "lt lv",
    "semitic": "ar he mt am",
    "indo-aryan": "hi bn ur mr gu pa ne",
    "turkic": "tr az kk uz",
}
UNDETERMINED = "und"
BUCKETS = 1024  # counters for each length of letter sequences
LENGTHS = (1, 2, 3)
FEATURES = BUCKETS * len(LENGTHS)
BLOCK = 1 << 20  # bytes whose sequences are counted at a time
SLOPE = 4.0  # of the logistic curve that turns a margin into a score

LETTER = regex.compile(r"\p{L}")
# ASCII signs and digits become spaces; bytes of other letters stay.
ONLY_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def family_of(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs.split()), lang)


def features(text: str) -> np.ndarray:
    """Counts of hashed 1 to 3 byte sequences of the whole text, as a unit vector."""
    letters = b" " + b" ".join(text.lower().encode().translate(ONLY_LETTERS).split()) + b" "
    codes = np.frombuffer(letters, np.uint8)
    counts = np.zeros((len(LENGTHS), BUCKETS))
    for begin in range(0, len(codes), BLOCK):
        for row, length in enumerate(LENGTHS):
            # A block's sequences begin in it and may end in the next one.
            block = codes[begin : begin + BLOCK + length - 1].astype(np.uint32)
            if len(block) < length:
                continue
            joined = np.zeros(len(block) - length + 1, np.uint32)
            for offset in range(length):
                joined = joined * np.uint32(257) + block[offset : len(block) - length + 1 + offset]
            hashed = (joined * np.uint32(2654435761)) >> np.uint32(22)
            counts[row] += np.bincount(hashed, minlength=BUCKETS)
    vector = np.sqrt(counts).ravel()
    return vector / (np.linalg.norm(vector) or 1.0)


class Model:
    """Linear machines between families, and between the languages of each family."""

    def __init__(self, languages: list[str]):
        self.groups: dict[str, list[str]] = {}
        for lang in sorted(languages):
            self.groups.setdefault(family_of(lang), []).append(lang)
        self.families = sorted(self.groups)
        # The winner of a pair is the first name where the margin is positive.
        self.machines: dict[tuple[str, str], tuple[np.ndarray, float]] = {}

    def pairs(self) -> list[tuple[str, str, list[str], list[str]]]:
        """Every machine: its two names and the languages that each stands for."""
        between = [(a, b, self.groups[a], self.groups[b]) for a, b in combinations(self.families, 2)]
        within = [
            (a, b, [a], [b]) for langs in self.groups.values() for a, b in combinations(langs, 2)
        ]
        return [(f"family {a}", f"family {b}", x, y) for a, b, x, y in between] + within

    def choose(self, names: list[str], label: str, vector: np.ndarray) -> tuple[str, float]:
        """Who wins most of the duels, and the chance of the winner's weakest duel."""
        wins = {name: [0, 0.0] for name in names}
        chance = {name: 1.0 for name in names}
        for a, b in combinations(names, 2):
            weights, intercept = self.machines[label + a, label + b]
            margin = float(vector @ weights + intercept)
            for name, own in ((a, margin), (b, -margin)):
                wins[name][0] += own > 0
                wins[name][1] += own
                sure = 1 / (1 + math.exp(-min(max(SLOPE * own, -50.0), 50.0)))
                chance[name] = min(chance[name], sure)
        best = max(names, key=lambda name: (*wins[name], name))
        return best, chance[best]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of a text and a score between 0 and 1."""
        if not text or not self.families or not LETTER.search(text):
            return UNDETERMINED, 0.0
        vector = features(text)
        family, sure = self.choose(self.families, "family ", vector)
        lang, surer = self.choose(self.groups[family], "", vector)
        return lang, sure * surer


def held_out(doc_id: str):
    """Documents never to learn from; those without an id are among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def learn(
    docs: DataFrame,
    per_language: int = 1000,
    iterations: int = 15,
    least: int = 5,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> Model:
    """A model of the languages of all rows that may be learnt from.

    Languages are counted over all rows. The machines are fitted on a sample that a
    hash of the id draws, about ``per_language`` texts of each language, whose size
    does not grow with the table. A label that fewer than ``least`` rows have is taken
    for a mistake and not learnt: each pair of labels of a family trains a machine. Rows
    without a text, a letter, a language or an id teach nothing.
    """
    able = docs.where(~held_out(doc_id) & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = {row[0]: row[1] for row in able.groupBy(lang).count().where(F.col("count") >= least).collect()}
    model = Model(list(counts))
    if not counts:
        return model
    share = F.lit(0.0)
    for name, count in counts.items():
        share = F.when(F.col(lang) == name, min(1.0, per_language / count)).otherwise(share)
    draw = (F.xxhash64(F.lit("learn"), F.col(doc_id)) / 2.0**64) + 0.5
    vector = F.udf(lambda t: features(t).tolist(), "array<float>", useArrow=True)
    sample = kept(able.where(draw < share).select(F.col(lang).alias("lang"), vector(F.col(text)).alias("x")), "language_sample")
    vectors = sample.select("lang", array_to_vector("x").alias("x")).coalesce(8).persist()
    for a, b, ours, theirs in model.pairs():
        duel = vectors.where(F.col("lang").isin(ours + theirs)).select(
            F.col("lang").isin(ours).cast("double").alias("y"), "x"
        )
        machine = LinearSVC(
            featuresCol="x", labelCol="y", maxIter=iterations, regParam=1e-4, standardization=False
        ).fit(duel)
        model.machines[a, b] = machine.coefficients.toArray(), machine.intercept
    vectors.unpersist()
    discarded(sample)
    return model


def predicted(spark: SparkSession, model: Model, text: Column) -> Column:
    """The prediction ``lang_pred, score`` for a text column."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    def predict(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(body.as_py()) for body in texts]
        return pa.array([{"lang_pred": x, "score": round(score, 6)} for x, score in found], kind)

    # Not deterministic for the planner, which would predict again for each use.
    return F.arrow_udf(predict, "lang_pred string, score double").asNondeterministic()(text)


def identify(
    docs: DataFrame, model: Model | None = None, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs``.

    Only the text is looked at, all of it. Without a ``model`` one is learnt from the
    rows (see :func:`learn`). A null text, one without a letter, and any text if no
    language was learnt, is ``und`` with score 0. The score is the product of the
    chances that the family and the language have in their closest duel; ties go to
    the larger margin, then to the later name. Rows that repeat give rows that
    repeat; an empty table gives an empty result.
    """
    if model is None:
        model = learn(docs, doc_id=doc_id, text=text, **options)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        held_out(doc_id).alias("held_out"),
        predicted(docs.sparkSession, model, whole_text(text)).alias("found"),
    )
    return rows.select("doc_id", "held_out", "found.lang_pred", "found.score")


def accepted(docs: DataFrame, least_score: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is in a language, all columns.

    Texts that are ``und`` (null and empty ones, and those without a letter, among them),
    and those for which no language scores ``least_score``, go. Rows that repeat stay or go
    together. An empty table gives an empty result, and so does one from which no language
    can be learnt. Columns of any other name are carried along.
    """
    model = learn(docs, doc_id=doc_id, text=text)
    found = predicted(docs.sparkSession, model, whole_text(text))
    rows = docs.select(F.struct("*").alias("_row"), found.alias("_found"))
    sure = (F.col("_found.lang_pred") != UNDETERMINED) & (F.col("_found.score") >= least_score)
    return rows.where(sure).select("_row.*")
