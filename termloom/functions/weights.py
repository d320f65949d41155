"""Term weights and the choices a report can be ordered or represented by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The orders of a best-terms report and the vector representations.
ORDERS = ("tf", "df", "tfxidf")
REPRESENTATIONS = ("bin", "tf", "tfxidf")


def check_choice(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}; got {value!r}")


def check_top(top: int) -> None:
    if top < 0:
        raise ValueError(f"top must not be negative; got {top}")


def idf(n_docs: Column, df: Column) -> Column:
    """Base-10, unsmoothed inverse document frequency over all documents."""
    return F.log10(n_docs.cast("double") / df)


def weight(rep: str, tf: Column, df: Column, n_docs: Column) -> Column:
    """Weight of a posting; a posting exists only where tf > 0."""
    check_choice("rep", rep, REPRESENTATIONS)
    if rep == "bin":
        return F.lit(1.0)
    if rep == "tf":
        return tf.cast("double")
    return tf * idf(n_docs, df)
