"""What the operators of this package share: shared scratch tables, words, collision-free column names."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable
from pathlib import Path
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
          "boolean": T.BooleanType(), "binary": T.BinaryType(), "array<long>": T.ArrayType(T.LongType()),
          "array<int>": T.ArrayType(T.IntegerType())}

#: A word is a run of characters that are neither a blank nor one of the five ASCII controls.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    A private one is set only where that is unset and Spark runs in this one process (tests);
    on a cluster an unset folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="airlattice-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_shipped: set[str] = set()
#: Bytes of text that one batch hands to a Python worker; a longer text is a batch of its own.
BATCH = "4m"


def ship_package(spark: SparkSession) -> SparkSession:
    """Give the executors this package, whose functions run there: once per application, through Spark's own file server.

    Batches to Python workers are bounded by bytes as well, since documents differ in length.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parents[1]
        target = os.path.join(tempfile.mkdtemp(), f"{root.name}.zip")
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(target)
        _shipped.add(app)
    return spark


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid4().hex}"


def stored(df: DataFrame, what: str = "stored") -> DataFrame:
    """The frame written once to the shared folder and read back: several passes, one computation, no lineage."""
    path = new_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a frame that ``stored`` returned, once nothing reads it any more."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(conf).delete(folder, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def row_type(fields: str) -> T.StructType:
    """A row type from "name type, ..." that needs no running session, unlike a DDL string."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in map(str.split, fields.split(", "))])


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names that the frame does not have yet, whatever its letter case."""
    have, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        name, n = stem, 0
        while name.lower() in have:
            n += 1
            name = f"{stem}_{n}"
        have.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(columns: dict[str, Column], kinds: dict[str, str]) -> Column:
    """128 bits of a row's values, nulls in their places included; ``kinds`` are the types as in ``dtypes``."""
    parts = []
    for name, c in columns.items():
        nested = kinds[name].startswith(("array", "map", "struct"))
        parts += [c.isNull(), F.to_json(F.struct(c.alias("c")), {"ignoreNullFields": "false"}) if nested else c]
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b"))


def whole_row_key(df: DataFrame) -> Column:
    """``row_key`` of all columns: only rows that are equal throughout share it."""
    return row_key({c: col(c) for c in df.columns}, dict(df.dtypes))


def words(text: str | None) -> list[bytes]:
    """Words as UTF-8 bytes: ``bytes.split`` divides at exactly the six blanks of WORD."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def span_string(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)
