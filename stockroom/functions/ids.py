"""Ids of the lines of a request, an order or a return.

A line's id is its parent's id times ``LINES_PER_ID`` plus its position, so
ids stay unique for parents of up to a million lines whose own ids are at
most ``MAX_PARENT_ID``. Validation refuses other requests; an id that would
still run into the next parent's stops the job instead.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

LINES_PER_ID = 1_000_000
MAX_PARENT_ID = 9_000_000_000_000


def line_id(parent: str, position_by: str) -> Column:
    """parent * LINES_PER_ID + position of the row in its parent."""
    position = F.row_number().over(Window.partitionBy(parent).orderBy(position_by))
    beyond = F.raise_error(F.concat(F.lit("more than 1000000 lines of parent "), F.col(parent).cast("string")))
    return F.when(position <= LINES_PER_ID, F.col(parent) * LINES_PER_ID + position).otherwise(beyond.cast("long"))
