"""Document fingerprints: the k smallest hashes of a text's word shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairsift.llm.common import WORD_GAP, whole_text

WORDS = 5  # words of a shingle
K = 128  # hashes of a sketch
WHITE = " \t\n\x0b\x0c\r"
KNOTS = 64
HASH_BITS = 63  # of a text's hash, which orders texts of one id


def word_hashes(text: Column) -> Column:
    """The hash of each word between ASCII white space."""
    trimmed = F.trim(text, F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))
    return F.transform(words, lambda word: F.xxhash64(word))


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text: str, sketch: str, k: int = K) -> DataFrame:
    """``df`` with the sketch of a text column: sorted, at most ``k`` hashes.

    A text of fewer than five words has one shingle, the whole sequence; one without
    words has an empty sketch.
    """
    # The hashes are a column of their own, so that the shingles look them up.
    hashed = df.withColumn(f"{sketch}_words", word_hashes(F.col(text)))
    words = F.col(f"{sketch}_words")
    count = F.size(words)

    def shingle(first: Column, at: Column) -> Column:
        return F.xxhash64(first, *(F.get(words, at + i) for i in range(1, WORDS)))

    shingles = (
        F.when(count >= WORDS, F.transform(F.slice(words, F.lit(1), F.greatest(count - WORDS + 1, F.lit(0))), shingle))
        .when(count > 0, F.array(F.xxhash64(words)))
        .otherwise(F.array().cast("array<bigint>"))
    )
    return hashed.withColumn(sketch, bottom(shingles, k)).drop(f"{sketch}_words")


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together, out of the parts' sketches."""
    return bottom(F.array_union(a, b), k)


def merged(df: DataFrame, key: str, sketch: str, k: int = K) -> DataFrame:
    """``key, sketch`` of all rows of a key together; each task sends ``k`` hashes per key."""
    hashes = df.select(key, F.explode(sketch).alias("_hash")).distinct()
    place = F.row_number().over(Window.partitionBy(key).orderBy("_hash"))
    least = hashes.withColumn("_place", place).where(F.col("_place") <= k)
    return least.groupBy(key).agg(F.sort_array(F.collect_list("_hash")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of both; two empty sketches are alike."""
    union = merge(a, b, k)
    common = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, 1.0).otherwise(common / F.size(union))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of different shingles; exact below ``k``."""
    reach = (F.element_at(sketch, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / reach)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too; 1 for an empty ``a``."""
    common = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    own = distinct_shingles(a, k)
    return F.when(own == 0, 1.0).otherwise(F.least(F.lit(1.0), common / own))


def as_text(sketch: Column) -> Column:
    """A sketch as hex digits, 16 per hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def text_order(text: Column) -> Column:
    """A number from 0 that orders the texts of one id, spread evenly whatever they are."""
    return F.shiftrightunsigned(F.xxhash64(text), 64 - HASH_BITS)


def ranges(docs: DataFrame, doc_id: str, order: str, parts: int) -> Column:
    """The number of the range of a row; later ranges have larger ids, or equal ids and larger ``order``.

    The ranges follow the ids' quantiles (at most :data:`KNOTS` numbers come to the
    driver) and cut the space between two quantiles evenly. An id that is two quantiles
    has a good share of the rows: it has ranges of its own, cut by ``order``, and so have
    rows without an id, which come first.
    """
    at = [i / KNOTS for i in range(KNOTS + 1)]
    found = docs.agg(F.percentile_approx(doc_id, at, 1000)).first()[0] or []
    knots = sorted(set(found))
    hot = [knot for knot in knots if found.count(knot) > 1]
    bits = max(1, parts).bit_length()
    within = F.shiftright(order, HASH_BITS - bits)
    if not knots:
        return within
    own = F.col(doc_id)
    cuts = -(-parts // max(1, len(knots) - 1))
    edges = F.array(*map(F.lit, knots))
    knot = F.greatest(F.size(F.filter(edges, lambda e: e <= own)), F.lit(1))
    low, high = F.element_at(edges, knot), F.element_at(edges, F.least(knot + 1, F.lit(len(knots))))
    width = F.greatest(high.cast("double") - low.cast("double"), F.lit(1.0))
    inside = F.floor((own.cast("double") - low.cast("double")) / width * cuts)
    inside = F.least(F.greatest(inside, F.lit(0)), F.lit(cuts - 1)) + 1
    is_hot = own.isin(hot) if hot else F.lit(False)
    base = knot * (cuts + 1) + F.when(is_hot, 0).otherwise(inside)
    cut = F.when(own.isNull(), within).otherwise(F.shiftleft(base.cast("long"), bits) + F.when(is_hot, within).otherwise(0))
    return cut.cast("long")


def compare_with_edits(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, parts: int | None = None
) -> DataFrame:
    """Fingerprints of every text and of an edited one, and how alike they are.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``: the edited text has its last floor(n_chars/2) code points replaced by
    the first as many of the next document in order of the id, the first one following
    the last. Rows without an id come first; rows with equal ids follow in order of
    their texts' hashes, then of their texts. A null text is empty. A single row is its
    own next one, an empty table gives an empty result; other columns are not read.

    Rows are dealt out by ``parts`` ranges of ids (default: four per shuffle
    partition), and rows without an id, or of an id that many rows have, by as many
    ranges of the hash. Each range also gets the first row of the one after it, so no
    task needs more than its range. Rows equal in both id and text lie in one range.
    """
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    rows = rows.withColumn("place", text_order(F.col("text")))
    rows = rows.withColumn("part", ranges(rows, "doc_id", "place", parts))
    first = rows.groupBy("part").agg(F.min(F.struct("doc_id", "place")).alias("first"))
    # One row per range, at most a few times ``parts`` and a few.
    by_part = Window.orderBy("part")
    follower = F.when(
        F.lead("part").over(by_part).isNotNull(), F.lead("first").over(by_part)
    ).otherwise(F.first("first").over(by_part))
    border = first.select(F.col("part").alias("into"), follower.alias("next"))
    border = border.select("into", F.col("next.doc_id").alias("next_id"), F.col("next.place").alias("next_place"))
    guests = rows.join(
        F.broadcast(border),
        F.col("doc_id").eqNullSafe(F.col("next_id")) & (F.col("place") == F.col("next_place")),
    ).select("doc_id", "text", "place", F.col("into").alias("part"), F.lit(1).alias("guest"))

    dealt = rows.withColumn("guest", F.lit(0)).unionByName(guests).repartition("part")
    dealt = with_sketch(dealt, "text", "sketch", k)
    order = Window.partitionBy("part").orderBy("guest", "doc_id", "place", "text")
    paired = dealt.select(
        "doc_id", "text", "sketch", "guest",
        F.lead("text").over(order).alias("next_text"),
        F.lead("sketch").over(order).alias("next_sketch"),
    ).where("guest = 0")
    length = F.char_length("text")
    half = F.floor(length / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), length - half), F.substring("next_text", F.lit(1), half))
    paired = paired.select(
        "doc_id", length.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited")
    )
    paired = with_sketch(paired, "edited", "edited_sketch", k)
    return paired.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )
