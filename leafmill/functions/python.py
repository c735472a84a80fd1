"""The few functions without a built-in counterpart, as Arrow-batched pandas UDFs."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


@F.pandas_udf(StringType())
def title_case(s: pd.Series) -> pd.Series:
    """Every run of letters capitalised, as in ``Newton'S Laws-Of (Motion) 2Nd``; null stays null."""
    return s.map(lambda x: None if x is None else x.title())


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two strings, lower-cased; 0 where either is null."""
    return pd.Series([0.0 if x is None or y is None else SequenceMatcher(None, x.lower(), y.lower()).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")
