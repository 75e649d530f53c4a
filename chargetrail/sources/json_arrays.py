"""Arrays of JSON objects, cut at the objects' ends by many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chargetrail.session import materialise

_BLOCK = ["_file", "_block"]


def _balance(parts: Column, outside: int) -> Column:
    """Opened less closed braces in every second of the `parts` between quotes."""
    own = F.filter(parts, lambda _, i: i % 2 == outside)
    text = F.array_join(own, "")
    return F.length(F.regexp_replace(text, "[^{]", "")) - F.length(F.regexp_replace(text, "[^}]", ""))


def json_array_records(spark: SparkSession, path: str, name: str = "record") -> DataFrame:
    """One text per object of the arrays in the files of `path`, each of which holds one array.

    Files are read as pieces that end with a closing brace, so Spark splits them as it splits lines. Whether a piece begins
    within a string, and how deep, follows from the pieces before it: each of Spark's blocks finds its quotes, and its
    depths for both cases, by itself; one row per block then tells the blocks how they begin, and another how many objects
    have ended before. The pieces of an object, which lie in one or two blocks, are put together at the end.

    Objects hold what JSON allows; what stands outside of them (an array's numbers, say) is left out, and so is an object
    that does not end. An empty file gives no rows.
    """
    pieces = spark.read.option("lineSep", "}").text(path)
    pieces = pieces.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_nth"),
        F.concat("value", F.lit("}")).alias("_text"),
    )
    # A backslash only stands in strings, so it can be taken out with what it escapes wherever a piece begins.
    parts = F.split(F.regexp_replace("_text", r"\\.", ""), '"')
    pieces = pieces.select("*", parts.alias("_parts")).select(
        *_BLOCK,
        "_nth",
        "_text",
        (F.size("_parts") - 1).alias("_quotes"),
        _balance(F.col("_parts"), 0).alias("_outside"),
        _balance(F.col("_parts"), 1).alias("_inside"),
    )
    nth = Window.partitionBy(*_BLOCK).orderBy("_nth")
    upto = nth.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quotes = F.sum("_quotes").over(upto)
    # For a block that begins outside of strings (0) and one that begins within one (1).
    deltas = [
        F.when((F.col("_before") + begins) % 2 == 0, F.col("_outside")).otherwise(F.col("_inside")).alias(f"_delta{begins}")
        for begins in (0, 1)
    ]
    pieces = pieces.withColumn("_before", quotes - F.col("_quotes")).select("*", *deltas)
    pieces = materialise(
        pieces.select(
            *_BLOCK,
            "_nth",
            "_text",
            "_quotes",
            "_before",
            *[F.sum(f"_delta{begins}").over(upto).alias(f"_depth{begins}") for begins in (0, 1)],
        ),
        "pieces",
    )
    blocks = pieces.groupBy(*_BLOCK).agg(
        F.sum("_quotes").alias("_quotes"),
        *[F.max_by(f"_depth{begins}", "_nth").alias(f"_depth{begins}") for begins in (0, 1)],
    )
    # One row per block of a file, in a window per file.
    by_file = Window.partitionBy("_file").orderBy("_block")
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    begun = blocks.select(
        *_BLOCK, "_depth0", "_depth1", (F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2).alias("_begins")
    )
    own = F.when(F.col("_begins") == 0, F.col("_depth0")).otherwise(F.col("_depth1"))
    begun = begun.select(
        *_BLOCK, "_begins", F.coalesce(F.sum(own).over(earlier), F.lit(0)).alias("_deep")
    )
    depth = F.when(F.col("_begins") == 0, F.col("_depth0")).otherwise(F.col("_depth1")) + F.col("_deep")
    closed = (F.col("_before") + F.col("_quotes") + F.col("_begins")) % 2 == 0
    placed = pieces.join(begun, _BLOCK).select(*_BLOCK, "_nth", "_text", ((depth == 0) & closed).cast("int").alias("_ends"))
    placed = materialise(placed, "placed")
    ended = placed.groupBy(*_BLOCK).agg(F.sum("_ends").alias("_ended"))
    ended = ended.select(*_BLOCK, F.coalesce(F.sum("_ended").over(earlier), F.lit(0)).alias("_records"))
    number = F.col("_records") + F.sum("_ends").over(upto) - F.col("_ends")
    numbered = placed.join(ended, _BLOCK).select("_file", number.alias("_record"), "_block", "_nth", "_text", "_ends")
    whole = numbered.groupBy("_file", "_record").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_nth", "_text"))).alias("_pieces"), F.max("_ends").alias("_ends")
    )
    text = F.array_join("_pieces._text", "")
    return whole.where("_ends = 1").select(
        F.regexp_replace(text, r"^[^{]*", "").alias(name), F.col("_file").alias("file"), F.col("_record").alias("number")
    )


def parsed_records(records: DataFrame, schema: StructType | str | None = None, name: str = "record") -> DataFrame:
    """The objects in the texts of column `name` as rows; without a schema it is inferred, which reads the texts twice."""
    if schema is not None:
        return records.select(F.from_json(name, schema).alias("_object")).select("_object.*")
    spark = records.sparkSession
    texts = materialise(records.select(name), "records")
    strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(spark.read._jreader.json(strings), spark)
