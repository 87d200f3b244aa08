"""Arrays as input of a generator."""

from pyspark.sql import Column, functions as F


def items(name: str) -> Column:
    """The elements of an array column, to be exploded.

    Exploding the bare column would make Spark add a filter on its size and push
    that below the steps which build the array, so they would run twice per row.
    """
    return F.filter(name, lambda x: x.isNotNull())
