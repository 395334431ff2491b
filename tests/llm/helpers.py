"""What the tests of this folder share."""

from __future__ import annotations

import random
import re

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for their own columns.
CLASHES = ["score", "shard", "kept", "label", "node", "size", "band", "_row", "_id", "part", "at", "copy"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    """Documents of ``(doc_id, text)`` or ``(doc_id, text, lang)``."""
    full = [(*row, "en")[:3] for row in rows]
    return spark.createDataFrame([(i, t, lang, "src", len(t or "")) for i, t, lang in full], COLUMNS)


def with_clashes(docs):
    """The documents with more columns, whose names mean something to the operators."""
    for name in CLASHES:
        docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


def odd_rows(seed=1):
    """Nulls, empty and long texts, ties, repeated rows, odd white space and letters."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    prose = [" ".join(rnd.choices(words, k=rnd.randint(20, 60))) for _ in range(30)]
    rows = [(i, text) for i, text in enumerate(prose)]
    rows += [(100 + i, text) for i, text in enumerate(prose[:8])]  # copies
    rows += [(200 + i, " ".join([*text.split()[:-1], "changed"])) for i, text in enumerate(prose[:8])]
    rows += [(300 + i, f"Before it {prose[9]} and after {i}") for i in range(4)]  # a shared passage
    rows += [(400, None), (401, ""), (402, " \t\n"), (403, "one"), (404, "Two words"), (405, "ÄÖ é 漢字 😀")]
    rows += [(406, " ".join(rnd.choices(words, k=30_000))), (407, "na " * 400), (408, "na " * 90)]
    rows += [(409, "x" * 5_000), (410, "a\x0bb\x0cc\x1cd\xa0e f")]
    rows += [(None, prose[0]), (None, "no id here"), (None, None), (5, prose[5]), (5, prose[5])]
    rows += [(411, prose[3]), (411, prose[4])]  # one id, two texts
    return rows


def words_of(text):
    return WORD.findall(text or "")


def got(df):
    """Rows as sorted tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
