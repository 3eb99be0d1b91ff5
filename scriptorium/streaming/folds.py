"""Row-local operators on streams: folds and scans are projections, so they run unchanged in micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def folded_stream(stream: DataFrame, text_col: str = "text") -> DataFrame:
    return stream.withColumn("body_fold", T.fold_english(T.clean_text(F.col(text_col))))


def scanned_stream(stream: DataFrame, folded: str, text_col: str = "text") -> DataFrame:
    return folded_stream(stream, text_col).filter(F.col("body_fold").contains(folded))
