"""Row predicates with explicit NULL behaviour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.functions.numeric import all_present


def non_negative(column: str, keep_null: bool = True) -> Column:
    col = F.col(column)
    return (col >= 0) | col.isNull() if keep_null else col >= 0


def measured(keys, measure: str) -> Column:
    """All keys present and a positive measure (the gate of a consolidated fact)."""
    return all_present(*keys) & (F.col(measure) > 0)


def excluding(column: str, values) -> Column:
    """NOT IN a literal list; NULL does not pass."""
    return ~F.col(column).isin(*values)


def since_date(column: str, first_day: str) -> Column:
    """Lower bound on an ISO date held as text; text comparison so that scans can push it down."""
    return F.col(column) >= F.lit(first_day)


def where_present(df: DataFrame, column: str, predicate: Column) -> DataFrame:
    """Apply the predicate only when the table has the column."""
    return df.filter(predicate) if column in df.columns else df


def require(df: DataFrame, *keys: str) -> DataFrame:
    """Drop rows that lack a mandatory key."""
    return df.dropna(how="any", subset=list(keys))
