import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from chargetrail.llm.registry import prepared

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        # names that the operators use inside
        StructField("size", StringType()),
        StructField("_id", StringType()),
        StructField("component", StringType()),
    ]
)

PASSAGE = " ".join(f"w{i}" for i in range(40))
LONG = " ".join(f"long{i % 977} of{i}" for i in range(30_000))


def texts():
    """Ids and texts with NULLs, empty and very long texts, ties, near copies and a repeated row."""
    rows = [
        (0, PASSAGE),
        (1, PASSAGE.replace(" ", " \t\n ")),
        (2, PASSAGE + " x"),
        (3, "before " + PASSAGE + " after that"),
        (4, None),
        (5, ""),
        (6, " \n "),
        (7, "One"),
        (8, "one"),
        (9, "two words"),
        (10, LONG),
        (11, LONG + " end"),
        (12, "a a a a a a a a a a a a a a a a a a a a"),
        (13, "a a a a a a a a a a a a a a"),
        (14, "Ünï  çødé’s   don't <|endoftext|> 12,345.67!? 　 x́ \U0001f600\n\n  end  "),
        (14, "Ünï  çødé’s   don't <|endoftext|> 12,345.67!? 　 x́ \U0001f600\n\n  end  "),
        (None, PASSAGE),
        (None, "nobody's text"),
    ]
    return rows + [(100 + i, PASSAGE) for i in range(30)]


@pytest.fixture(scope="session")
def docs(spark):
    prepared(spark)
    rows = [(i, t, "en", None if (i or 0) % 3 == 0 else f"s{(i or 0) % 4}", 1, "no", "x", None) for i, t in texts()]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    prepared(spark)
    return spark.createDataFrame([], DOCS)
