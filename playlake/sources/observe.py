"""Count the rows a write job handles, in that same job.

``DataFrame.observe`` attaches a named aggregate that the executors compute while the
write runs, so "rows inserted" costs no second pass over the data.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    obs = Observation(f"rows-{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def metric(obs: Observation, name: str) -> int | None:
    """The metric ``name`` of the finished action that carried ``obs``, or None if it has none.

    Adaptive execution replaces a plan whose stages gave no rows by an empty one, and the
    metrics go with it; reading them then fails an assertion instead of giving nothing.
    """
    try:
        value = obs.get.get(name)
    except AssertionError:
        return None
    except Py4JJavaError as err:
        if err.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return None
    return None if value is None else int(value)


def rows_of(obs: Observation) -> int:
    """Rows seen by the finished action that carried ``obs``; no metric means no row."""
    return metric(obs, "rows") or 0
