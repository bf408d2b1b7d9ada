import pytest


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, empty and very long texts, repeated rows, and columns whose names may clash."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (1, "one two three four five six", "src0", "en"),
        (2, "one two three four five six", "src0", "en"),
        (2, "one two three four five six", "src0", "en"),
        (3, None, None, None),
        (4, "", "src1", None),
        (None, "one two three four five six", "src1", "de"),
        (None, None, None, None),
        (5, " \t\n", "src0", "de"),
        (6, "ONE two\tthree  four five six", "src2", "en"),
        (7, long, "src0", "fr"),
        (8, long + " end", "src1", "fr"),
        (9, "12345 67890 !!", None, "es"),
        (10, "x" * 200_000, "src0", "en"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    from pyspark.sql import functions as F

    for clash in ("id", "key", "digest", "size", "n", "k0", "rank", "length", "spans", "score"):
        frame = frame.withColumn(clash, F.lit("clash"))
    return frame


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
