"""Column expressions that repair raw values. Missing is always SQL NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters stripped from both ends of text.
BLANKS = " \t\n\r\x0b\x0c"
#: Text read as a number, the infinite ones included.
READABLE_TEXT = (
    r"^[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
)
#: Text read as a whole number.
WHOLE_TEXT = r"^[+-]?[0-9]+$"


def as_column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def stripped(column: str | Column) -> Column:
    """Text without surrounding white space."""
    return F.btrim(as_column(column), F.lit(BLANKS))


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def to_number(df: DataFrame, column: str) -> Column:
    """Double value of a column; blank, unreadable and NaN become null."""
    if not is_text(df, column):
        return nan_to_null(F.col(column).cast("double"))
    text = stripped(column)
    return F.when(text.rlike(READABLE_TEXT), text.try_cast("double"))


def to_flag(df: DataFrame, column: str) -> Column:
    """0/1 flag as a long; missing and unreadable become 0."""
    return F.coalesce(to_number(df, column), F.lit(0.0)).cast("long")


def blank_to_null(column: str | Column) -> Column:
    """Stripped text, null when nothing is left."""
    text = stripped(column)
    return F.when(text != "", text)


def required_score(score: Column) -> Column:
    """A score as a double. Null and NaN stop the job, in tables of every size.

    Rows without a score have no place in a ranking or on a side of a cut; leaving them out would
    change every metric without a word. ``threshold.score_faults`` counts them.
    """
    score = score.cast("double")
    bad = score.isNull() | F.isnan(score)
    return F.when(bad, F.raise_error(F.lit("a score is null or NaN"))).otherwise(score)


def clean_nans(df: DataFrame) -> DataFrame:
    """Every float column with NaN turned into null; other columns untouched."""
    floats = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    if not floats:
        return df
    return df.withColumns({c: nan_to_null(F.col(c)) for c in floats})
