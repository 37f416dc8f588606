"""Row ids in UUID form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def random_id() -> Column:
    """A new random UUID per row: a replayed row gets another one."""
    return F.expr("uuid()")


def stable_id(*position: Column) -> Column:
    """An id that depends only on where the record sits in its log, so a replay repeats it.

    NULL where a part of the position is NULL: such a record has no place of its own.
    """
    parts = [part.cast("string") for part in position]
    spaced = [x for part in parts for x in (F.lit(":"), part)][1:]
    digest = F.sha2(F.concat(*spaced), 256)
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-"),
        F.substring(digest, 13, 4),
        F.lit("-"),
        F.substring(digest, 17, 4),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )
