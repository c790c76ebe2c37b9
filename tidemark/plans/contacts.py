"""Phone dimension out of a main and a secondary system."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import clean_phone, phone_class
from tidemark.operators.joins import exclude
from tidemark.operators.sets import union_sources


def phone_dimension(main: DataFrame, other: DataFrame) -> DataFrame:
    """Cleaned, classified phones; the other system only adds clients the main one has no phone for."""

    def cleaned(df: DataFrame) -> DataFrame:
        tidy = df.select("client_id", clean_phone("phone").alias("cleaned"))
        return tidy.where(F.col("cleaned").isNotNull()).distinct()

    first = cleaned(main)
    rest = exclude(cleaned(other), first, "client_id")
    return union_sources({"main": first, "other": rest}).withColumn("class", phone_class("cleaned"))
