"""What several operators share: word rules, sessions, rows in and out of Python."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorecard.operators.staging import stage

# The six characters that separate words and are deleted by normalisation.
WHITE = "\t\n\x0b\x0c\r "
WHITE_BYTES = WHITE.encode()

# Rows and bytes of one Arrow batch. Texts may be long, so batches are short.
BATCH_ROWS = 512
BATCH_BYTES = 4 << 20

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def prepare(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches, and give the executors this package.

    Python workers look functions up by name, so a cluster whose executors do not
    share the driver's files gets the sources through Spark's own file server.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_scorecard_shipped", False):
        return spark
    path = os.path.join(context._temp_dir, "scorecard.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    context.addPyFile(path)
    context._scorecard_shipped = True
    return spark


def texts_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; a null text counts as empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def text_key() -> Column:
    """A number for the whole text; with doc_id it names a row's content."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def keep_rows(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``verdicts`` (doc_id, text_key, kept) keeps, all columns.

    Rows repeated with the same doc_id and text are one document: one row stays.
    """
    # The user's row is one struct, so that no name of it meets one of these.
    rows = docs.select(F.struct("*").alias("row"), "doc_id", text_key().alias("text_key"))
    named = [F.col("doc_id").alias("id"), F.col("text_key").alias("key")]
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
    kept = verdicts.where("kept").groupBy("doc_id", "text_key").agg(F.first("kept").alias("kept"))
    stays = rows.join(kept.select(*named), same, "left_semi")
    repeated = verdicts.groupBy("doc_id", "text_key").count().where("count > 1")
    repeated = stage(repeated.select(*named), "repeated")
    if repeated.isEmpty():
        return stays.select("row.*")
    single = stays.join(repeated, same, "left_anti")
    several = stays.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text_key"])
    return single.unionByName(several).select("row.*")


def replaced(text: Column, characters: str, by: str = "") -> Column:
    """Each of ``characters`` replaced; byte searches, far faster than translate."""
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(by))
    return text


def without_white(text: Column) -> Column:
    """``text`` without its white space."""
    return replaced(text, WHITE)


def word_array(text: Column) -> Column:
    """Maximal runs of other characters than white space."""
    return F.array_remove(F.split(replaced(text, WHITE[:-1], " "), " "), "")


def map_rows(
    df: DataFrame, rows: Callable[[list, list], list[list]], schema: str
) -> DataFrame:
    """Apply ``rows`` to the columns of each Arrow batch.

    ``rows`` takes the input columns as lists and returns the output columns.
    """
    fields = [part.split() for part in schema.split(",")]
    kinds = {
        "long": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "binary": pa.binary(),
        "boolean": pa.bool_(),
    }
    types = [(name, kinds[kind]) for name, kind in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = rows(*[c.to_pylist() for c in batch.columns])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)],
                names=[n for n, _ in types],
            )

    return df.mapInArrow(run, schema)
