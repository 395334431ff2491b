"""What a stage table was made with: written beside its rows, compared before it is used again."""

from __future__ import annotations

import hashlib
import inspect
import json
import re
from collections.abc import Iterable
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsift.stages import file_system

# Names of notes; Spark's readers leave out files with an underscore.
MADE_OF = "_manifest"  # what the table was made with
ROWS = "_rows"  # what was counted while it was made
Recipe = dict[str, object]


def write_note(spark: SparkSession, folder: str, note: Recipe, name: str = MADE_OF) -> None:
    """Writes a note into the folder of a stage table that is complete."""
    files, path = file_system(spark, f"{folder}/{name}")
    out = files.create(path, True)
    try:
        out.write(bytearray(json.dumps(note, sort_keys=True, indent=1).encode()))
    finally:
        out.close()


def read_note(spark: SparkSession, folder: str, name: str = MADE_OF) -> Recipe | None:
    """A note of a folder; None if there is none."""
    files, path = file_system(spark, f"{folder}/{name}")
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def digest(value: object) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True).encode()).hexdigest()


def code_of(modules: Iterable[ModuleType]) -> str:
    """A digest of the modules' source, so that stages of other code are not taken."""
    return digest([inspect.getsource(module) for module in modules])


def files_of(spark: SparkSession, paths: Iterable[str]) -> list[list]:
    """``path, bytes, time of change`` of all files under paths, in order.

    Patterns are resolved; files that Spark's readers leave out are left out.
    """
    found = []
    for name in paths:
        files, pattern = file_system(spark, name)
        for root in files.globStatus(pattern) or []:
            below = files.listFiles(root.getPath(), True)
            while below.hasNext():
                status = below.next()
                path = status.getPath()
                if path.getName()[0] not in "_.":
                    found.append([path.toString(), status.getLen(), status.getModificationTime()])
    return sorted(found)


def all_from_files(df: DataFrame) -> bool:
    """Whether every row of a DataFrame comes out of files that it can name."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    names = {leaves.apply(i).getClass().getSimpleName() for i in range(leaves.size())}
    return names == {"LogicalRelation"} and len(df.inputFiles()) > 0


def plan_of(df: DataFrame) -> str:
    """What is computed from the files, without the numbers that differ from run to run."""
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().analyzed().toString())


def input_of(df: DataFrame, paths: Iterable[str] | None = None) -> Recipe | None:
    """What identifies an input: its files and the steps from them; None if that cannot be told.

    ``paths`` names the files of a DataFrame that does not know them (an RDD's).
    """
    spark = df.sparkSession
    if paths is not None:
        return {"files": files_of(spark, paths), "plan": plan_of(df)}
    if not all_from_files(df):
        return None
    return {"files": files_of(spark, df.inputFiles()), "plan": plan_of(df)}


def words_digest(words: Iterable[str] | DataFrame) -> str:
    """A digest of a set of words in any case, from a list or a table ``w``.

    A table is summed up by Spark: the number of different words and two sums of their
    hashes, whatever their order.
    """
    if not isinstance(words, DataFrame):
        return digest(sorted({word.lower() for word in words}))
    word = F.lower("w")
    different = words.where("w IS NOT NULL").select(word.alias("w")).distinct()
    halves = [F.sum(F.conv(F.substring(F.md5("w"), at, 15), 16, 10).cast("decimal(38,0)")) for at in (1, 16)]
    return digest([str(value) for value in different.agg(F.count("*"), *halves).first()])
