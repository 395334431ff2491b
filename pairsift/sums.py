"""Sums that are kept from run to run; new files are merged into the decades they touch."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsift.manifests import files_of, read_note, write_note
from pairsift.stages import file_system, removed

COMMIT = "_load-"
FILES = "path string, bytes long, changed long"


class StoredSums:
    """A table of sums by ``decade`` and other columns, in a folder that all machines share.

    Each load writes the decades that its files touch anew, merged with what was stored,
    into a folder of its own, and then one small note, which says where each decade stands
    now. A run that dies before the note has changed nothing; what it left is replaced by
    the next load. A file counts once, by its path, size and time of change, however often
    it is given; one that was changed after it was loaded is an error, as its old lines
    are in the sums. One load at a time may write.
    """

    def __init__(self, spark: SparkSession, folder: str, key: list[str], count: str):
        self.spark, self.folder, self.key, self.count = spark, folder.rstrip("/"), key, count

    def loads(self) -> list[int]:
        """The numbers of the loads that were finished."""
        files, path = file_system(self.spark, f"{self.folder}/{COMMIT}*")
        found = [status.getPath().getName().removeprefix(COMMIT) for status in files.globStatus(path) or []]
        return sorted(int(number) for number in found if number.isdigit() and self._note(int(number)) is not None)

    def _note(self, number: int) -> dict | None:
        try:
            return read_note(self.spark, self.folder, f"{COMMIT}{number}")
        except json.JSONDecodeError:  # cut off while it was written
            return None

    def decades(self) -> dict[str, int]:
        """The load in which each decade was written last."""
        loads = self.loads()
        return self._note(loads[-1])["decades"] if loads else {}

    def files(self) -> DataFrame:
        """``path, bytes, changed`` of all files in the sums."""
        folders = [f"{self.folder}/files/{number}" for number in self.loads()]
        reader = self.spark.read.schema(FILES)
        return reader.parquet(*folders) if folders else self.spark.createDataFrame([], FILES)

    def rows(self, schema: str, decades: Iterable[str] | None = None) -> DataFrame:
        """The sums, of all decades or of some."""
        places = self.decades()
        wanted = sorted(places) if decades is None else sorted(set(decades) & set(places))
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.folder}/sums/{places[decade]}/{decade}" for decade in wanted]
        return self.spark.read.schema(schema).parquet(*paths)

    def load(self, paths: Iterable[str], counted: Callable[[list[str]], DataFrame], schema: str) -> list[str]:
        """Merges the lines of files that are new; the decades that were written.

        ``counted`` makes sums (with the key columns and the count) of a list of files.
        """
        found = self.spark.createDataFrame(files_of(self.spark, paths), FILES).distinct()
        known = self.files().select("path", F.col("bytes").alias("b"), F.col("changed").alias("c"))
        both = found.join(known, "path", "left")
        other = both.where((F.col("b") != F.col("bytes")) | (F.col("c") != F.col("changed"))).limit(1).collect()
        if other:
            raise ValueError(f"{other[0]['path']} was changed after it was loaded")
        new = both.where("b IS NULL").select("path", "bytes", "changed")
        names = [row["path"] for row in new.collect()]  # the names of the load's own files
        if not names:
            return []
        number = max(self.loads(), default=0) + 1
        fresh_at, sums_at = f"{self.folder}/fresh/{number}", f"{self.folder}/sums/{number}"
        removed(self.spark, sums_at)
        new.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/files/{number}")
        # Stored, as it is asked for its decades first and lines are read once.
        counted(names).write.mode("overwrite").parquet(fresh_at)
        fresh = self.spark.read.schema(schema).parquet(fresh_at)
        touched = sorted(str(row["decade"]) for row in fresh.select("decade").distinct().collect())
        columns = [*self.key, self.count]
        merged = self.rows(schema, touched).select(*columns).unionByName(fresh.select(*columns))
        merged = merged.groupBy(*self.key).agg(F.sum(self.count).alias(self.count))
        # One folder per decade, named by the decade alone; its column stays in the rows.
        by_decade = merged.withColumn("_of", F.col("decade"))
        by_decade.write.partitionBy("_of").parquet(sums_at)
        self._rename(sums_at)
        places = self.decades() | {decade: number for decade in touched}
        write_note(self.spark, self.folder, {"decades": places}, f"{COMMIT}{number}")
        removed(self.spark, fresh_at)
        return touched

    def _rename(self, folder: str) -> None:
        """``_of=1990`` to ``1990``, so that a decade is a table and no partition of one."""
        files, path = file_system(self.spark, f"{folder}/_of=*")
        for status in files.globStatus(path):
            old = status.getPath()
            name = old.getName().removeprefix("_of=")
            files.rename(old, file_system(self.spark, f"{folder}/{name}")[1])

    def cleaned(self) -> None:
        """Removes the folders of decades that later loads have written again."""
        places = self.decades()
        for number in self.loads():
            files, path = file_system(self.spark, f"{self.folder}/sums/{number}/*")
            for status in files.globStatus(path) or []:
                name = status.getPath().getName()
                if name.lstrip("-").isdigit() and places.get(name) != number:
                    files.delete(status.getPath(), True)
