"""Line dedup against levelled, sorted runs of line hashes.

Documents come in batches of increasing doc_id. The keys of a batch are reduced to one row per hash, merge-anti-joined
with every run, and what is new becomes a run of its own: a Parquet table bucketed and sorted by hash, so that later
joins read it as it lies. When a level holds ``fanout`` runs they are merged into one run of the next level; a key is
thus rewritten once per level, and a batch meets few runs. All steps are DataFrame operations.

A line's key is the line without ASCII blanks at both ends, A-Z in lower case. Keys of at least ``least`` code points
that several documents hold lose all their lines, except in the first document that holds them.

Defined results: a null or empty text is one empty line. The first document is the one with the smallest doc_id; rows
that share a doc_id are one document, so none of them takes a line from another. Rows without doc_id come after all
others, are told apart by their text alone, and the one with the smallest text hash is the first of them. Equal rows get
equal results, repeated lines of the first document all stay, an empty table gives no rows, other columns pass unchanged
whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlattice.llm.common import BLANKS, col, fresh, new_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST = 10
#: Batches of a table that is there as a whole, and runs of a level that are merged into one.
BATCHES, FANOUT = 4, 3


def line_key(bare: Column) -> Column:
    """A-Z in lower case. ASCII lines go by the built-in function, which is far faster than a character table."""
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def _text(text: str) -> Column:
    return F.coalesce(col(text), F.lit(""))


def _row(doc_id: str, text: str) -> list[Column]:
    """128 bits of what tells documents apart: ``ra``, ``rb``."""
    number = col(doc_id).cast("long")
    return [F.xxhash64(F.lit(seed), number.isNull(), number, _text(text)).alias(name) for seed, name in ((1, "ra"), (2, "rb"))]


def hashed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, **keep: Column) -> DataFrame:
    """(id, ra, rb, pos, a, b): the lines that can be repeats, by position from 0, and the 128-bit hash of their keys.

    ``keep`` names further columns of a line's document.
    """
    bare = F.btrim("line", F.lit(BLANKS))
    # The hashes of the text come before the lines, else they would be made anew for every line.
    whole = docs.select(col(doc_id).cast("long").alias("id"), *_row(doc_id, text), *[c.alias(name) for name, c in keep.items()],
                        F.split(_text(text), "\n", -1).alias("lines"))
    lines = whole.select("id", "ra", "rb", *keep, F.posexplode("lines").alias("pos", "line"))
    key = line_key(bare)
    return lines.where(F.char_length(bare) >= least).select(
        "id", "ra", "rb", "pos", F.xxhash64(key).alias("a"), F.xxhash64(F.lit(3), key).alias("b"), *keep)


@dataclass
class Run:
    """One sorted run: a bucketed table and its folder."""

    name: str
    path: str


@dataclass
class LineRuns:
    """The hashes of all batches so far. ``levels[k]`` holds runs of about ``fanout ** k`` batches each."""

    spark: SparkSession
    fanout: int = FANOUT
    levels: list[list[Run]] = field(default_factory=list)

    def runs(self) -> list[Run]:
        return [run for level in self.levels for run in level]

    def _write(self, keys: DataFrame) -> Run:
        run = Run(f"line_run_{uuid4().hex}", new_folder(self.spark, "line-run"))
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        keys.repartition(buckets, "a", "b").write.bucketBy(buckets, "a", "b").sortBy("a", "b").option("path", run.path).saveAsTable(run.name)
        return run

    def forget(self, run: Run) -> None:
        self.spark.sql(f"DROP TABLE {run.name}")
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(run.path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def close(self) -> None:
        for run in self.runs():
            self.forget(run)
        self.levels = []

    def add(self, lines: DataFrame) -> DataFrame:
        """Adds a batch of ``hashed_lines`` and returns (ra, rb, pos) of its lines to drop.

        Both sides of the last join are shuffled, the own run read as plain files, so that adaptive execution can
        split the rows of a line that very many documents hold.
        """
        keys = lines.groupBy("a", "b").agg(F.min("id").alias("first_id"), F.min(F.when(F.col("id").isNull(), F.col("ra"))).alias("first_row"))
        for run in self.runs():
            keys = keys.join(self.spark.table(run.name).select("a", "b"), ["a", "b"], "left_anti")
        own = self._write(keys)
        self.levels = self.levels or [[]]
        self.levels[0].append(own)
        first = self.spark.read.schema("a LONG, b LONG, first_id LONG, first_row LONG").parquet(own.path)
        later = F.col("first_id").isNull() & F.col("first_row").isNull()  # an earlier batch has it
        later |= F.when(F.col("id").isNotNull(), F.col("id") > F.col("first_id")).otherwise(
            F.col("first_id").isNotNull() | (F.col("ra") > F.col("first_row")))
        return lines.join(first, ["a", "b"], "left").where(later).select("ra", "rb", "pos")

    def compact(self) -> None:
        """Merges every level that is full. Call it when the frames that ``add`` returned have been used."""
        k = 0
        while k < len(self.levels):
            if len(self.levels[k]) >= self.fanout:
                full, self.levels[k] = self.levels[k], []
                merged = self.spark.table(full[0].name)
                for run in full[1:]:
                    merged = merged.unionByName(self.spark.table(run.name))
                new = self._write(merged)
                self.levels += [[]] if k + 1 == len(self.levels) else []
                self.levels[k + 1].append(new)
                for run in full:
                    self.forget(run)
            k += 1


def batch_number(docs: DataFrame, doc_id: str, batches: int) -> Column:
    """Ranges of doc_id with about equally many rows; rows without one come last."""
    number = col(doc_id).cast("long")
    cuts = docs.agg(F.percentile_approx(number, [(k + 1) / batches for k in range(batches - 1)] or [1.0]).alias("cuts")).first().cuts
    cuts = sorted(set(cuts or []))[:batches - 1]
    return F.when(number.isNull(), F.lit(len(cuts))).otherwise(sum(((number > cut).cast("int") for cut in cuts), F.lit(0)))


def without_lines(text: Column, dropped: Column) -> Column:
    """The text without its lines at the ``dropped`` positions, in time that grows with the lines of the text."""
    def kept(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
        return F.array_join(F.transform(places, lambda p: lines[p]), "\n")

    return F.element_at(F.transform(F.array(F.split(text, "\n", -1)), kept), 1)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, batches: int = BATCHES,
                fanout: int = FANOUT) -> DataFrame:
    """``docs`` and a struct ``line_dedup`` (n_lines, n_dropped, text), named otherwise where that is a column already.

    The texts are read twice: once for the hashes of their lines, which are stored by batch, and once to take lines out.
    Only hashes go through the batches.
    """
    spark = docs.sparkSession
    path = new_folder(spark, "line-hashes")
    hashed = hashed_lines(docs, doc_id, text, least, batch=batch_number(docs, doc_id, batches))
    hashed.write.partitionBy("batch").parquet(path)
    stored = spark.read.schema("id LONG, ra LONG, rb LONG, pos INT, a LONG, b LONG, batch INT").parquet(path)
    runs, drops = LineRuns(spark, fanout), new_folder(spark, "line-drops")
    for k in range(batches):
        gone = runs.add(stored.where(F.col("batch") == k).drop("batch"))
        gone.groupBy("ra", "rb").agg(F.collect_set("pos").alias("gone")).write.mode("append").parquet(drops)
        runs.compact()
    runs.close()
    a, b, gone, out = fresh(docs, "ra", "rb", "gone", "line_dedup")
    ra, rb = _row(doc_id, text)
    found = spark.read.schema("ra LONG, rb LONG, gone ARRAY<INT>").parquet(drops).withColumnsRenamed({"ra": a, "rb": b, "gone": gone})
    whole = docs.select("*", ra.alias(a), rb.alias(b)).join(found, [a, b], "left")
    own = _text(text)
    result = F.struct(
        (F.char_length(own) - F.char_length(F.replace(own, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.when(col(gone).isNull(), 0).otherwise(F.size(col(gone))).cast("long").alias("n_dropped"),
        F.when(col(gone).isNull(), own).otherwise(without_lines(own, col(gone))).alias("text"))
    return whole.select(*[col(c) for c in docs.columns], result.alias(out))

