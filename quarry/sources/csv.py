"""Headerless all-numeric CSV sources with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column layouts of the two numeric tables
# ---------------------------------------------------------------------------
COVER_CONTINUOUS = [
    "Elevation", "Aspect", "Slope", "Horizontal_Distance_To_Hydrology",
    "Vertical_Distance_To_Hydrology", "Horizontal_Distance_To_Roadways",
    "Hillshade_9am", "Hillshade_Noon", "Hillshade_3pm",
    "Horizontal_Distance_To_Fire_Points",
]
COVER_WILDERNESS = 4   # binary indicator columns WA_0..WA_3
COVER_SOIL = 40        # binary indicator columns ST_0..ST_39
COVER_LABEL = "Cover_Type"
PARTICLE_FEATURES = 28  # label first, then 28 continuous features


def cover_columns() -> list[str]:
    return (COVER_CONTINUOUS + [f"WA_{i}" for i in range(COVER_WILDERNESS)]
            + [f"ST_{i}" for i in range(COVER_SOIL)] + [COVER_LABEL])


def particle_columns() -> list[str]:
    return ["label"] + [f"f{i}" for i in range(1, PARTICLE_FEATURES + 1)]


def numeric_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def scan_numeric_csv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Read a headerless numeric CSV with a fixed schema; blanks are trimmed, a bad number or a short row fails the job."""
    return (spark.read.schema(numeric_schema(names))
            .option("header", "false")
            .option("ignoreLeadingWhiteSpace", "true")
            .option("ignoreTrailingWhiteSpace", "true")
            .option("mode", "FAILFAST")
            .csv(path))


def scan_numeric_csv_rejects(spark: SparkSession, path: str, names: list[str], line_col: str = "line") -> tuple[DataFrame, DataFrame]:
    """The good rows and, as a second frame, the lines that ``scan_numeric_csv`` would fail on.

    Both come from one parse of each line into all columns: a line is
    rejected if it has a bad number or another number of fields, whichever
    columns the caller reads later (the file reader checks only those it
    reads). A generator binds the parsed line; persist or write one of the
    frames' common parent, ``parsed_lines``, to read the files once for both.
    Blank lines are neither.
    """
    parsed = parsed_lines(spark, path, names, line_col)
    bad = F.col(f"row.{line_col}").isNotNull()
    return (parsed.where(~bad).select(*[F.col("row")[n].alias(n) for n in names]),
            parsed.where(bad).select(F.col("row")[line_col].alias(line_col)))


def parsed_lines(spark: SparkSession, path: str, names: list[str], line_col: str = "line") -> DataFrame:
    """``row``: a struct of all columns, and of the line itself where it is no such row."""
    schema = numeric_schema(names).add(line_col, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": line_col,
               "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    row = F.from_csv(F.col("value"), schema.simpleString()[len("struct<"):-1].replace(":", " "), options)
    return (spark.read.text(path).where(F.trim("value") != "")
            .select(F.explode(F.array(row)).alias("row")))
