"""Names, codes and masks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: mail domain used when none is given.
DEFAULT_DOMAIN = "@example.com"


def split_on(column: str | Column, separator: str) -> Column:
    """Split at a literal separator; Spark's own split takes a pattern."""
    if len(separator) > 1:
        return F.split(column, f"\\Q{separator}\\E")
    return F.split(column, f"\\{separator}" if separator in "\\^$.|?*+()[]{}" else separator)


def described(subject: str, what: str) -> Column:
    """``<subject> is a <what>``; null when either part is."""
    return F.concat(F.col(subject), F.lit(" is a "), F.col(what))


def part_of(column: str, separator: str, index: int) -> Column:
    """Field ``index`` (from 0) of delimited text, null when there are fewer."""
    return F.get(split_on(column, separator), F.lit(index))


def mail_address(first: str, last: str, domain: str = DEFAULT_DOMAIN) -> Column:
    return F.concat(F.col(first), F.col(last), F.lit(domain))


def yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit("yes")).otherwise(F.lit("no"))


def band(column: str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label by half-open ranges: below the first edge, between edges, from the last on.

    A null value has no band and stays null.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    value = F.col(column)
    chosen = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        chosen = chosen.when(value < edge, F.lit(label))
    return chosen.otherwise(F.lit(labels[-1]))


# Under 13, 13 to 18 inclusive, above 18.
AGE_EDGES = (13, 18)
AGE_LABELS = ("Children", "Teen", "Adults")


def age_group(column: str) -> Column:
    """Label of an age, whole or not; null has none."""
    age, (young, grown), (low, middle, high) = F.col(column), AGE_EDGES, AGE_LABELS
    labelled = F.when(age < young, low).when(age <= grown, middle)
    return labelled.when(age.isNotNull(), high)


def mask(df: DataFrame, columns: Mapping[str, str | tuple[str, int]]) -> DataFrame:
    """Hash columns: ``"md5"``, or ``("sha2", bits)``; equal inputs stay equal."""
    masked = {}
    for name, method in columns.items():
        text = F.col(name).cast("string")
        if method == "md5":
            masked[name] = F.md5(text)
        elif isinstance(method, tuple) and method[0] == "sha2":
            masked[name] = F.sha2(text, method[1])
        else:
            raise ValueError(f"unknown mask {method!r}")
    return df.withColumns(masked)
