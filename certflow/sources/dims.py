"""The three static dimension tables and J11, the look-up against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed values.
RATINGS = [
    ("A", "A - Excellent", "Very energy efficient", 1),
    ("B", "B - Good", "Energy efficient", 2),
    ("C", "C - Fairly Good", "Fairly energy efficient", 3),
    ("D", "D - Average", "Average energy efficiency", 4),
    ("E", "E - Below Average", "Below average energy efficiency", 5),
    ("F", "F - Poor", "Poor energy efficiency", 6),
    ("G", "G - Very Poor", "Very poor energy efficiency", 7),
]
BUILDING_TYPES = [
    (1, "RES_HOUSE", "Residential House", "Residential"),
    (2, "RES_APT", "Residential Apartment", "Residential"),
    (3, "COM_OFFICE", "Commercial Office", "Commercial"),
    (4, "COM_RETAIL", "Commercial Retail", "Commercial"),
    (5, "IND_WAREHOUSE", "Industrial Warehouse", "Industrial"),
    (6, "PUB_SCHOOL", "Public School", "Public"),
    (7, "PUB_HOSPITAL", "Public Hospital", "Public"),
]
STATUSES = [
    (1, "PENDING", "Pending", "Awaiting processing", True),
    (2, "PROCESSING", "Processing", "Currently being processed", True),
    (3, "COMPLETED", "Completed", "Processing completed successfully", True),
    (4, "ERROR", "Error", "Processing failed with error", True),
    (5, "RETRY", "Retry", "Marked for retry processing", True),
    (6, "ARCHIVED", "Archived", "Archived after processing", True),
]


def ratings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RATINGS, "RatingCode string, RatingName string, Description string, SortOrder int")


def building_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BUILDING_TYPES, "TypeID int, TypeCode string, TypeName string, Category string")


def statuses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        STATUSES, "StatusID int, StatusCode string, StatusName string, Description string, IsActive boolean"
    )


def look_up(rows: DataFrame, dim: DataFrame, column: str, code: str) -> DataFrame:
    """Left join with a dimension of this module.

    The broadcast is safe: these tables hold at most seven rows, whatever the input.
    """
    return rows.join(F.broadcast(dim), rows[column] == dim[code], "left").drop(dim[code])
