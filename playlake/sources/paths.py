"""Partition folders of a date range, found by a directory-only glob.

Handing a reader the table root makes Spark list every data file of the whole
history before pruning. For a bounded date range the reader gets only the
folders of that range: the listing then grows with the range, not the history.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

_DAY = re.compile(r"year=(\d+)/month=(\d+)/day=(\d+)/?$")
_DATE = re.compile(r"snapshot_date=(\d{4}-\d{2}-\d{2})/?$")
_MONTH = re.compile(r"snapshot_month=(\d{6})/?$")


def no_such_path(err: AnalysisException) -> bool:
    return err.getCondition() == "PATH_NOT_FOUND"


def _glob_dirs(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(jpath)
    return [st.getPath().toString() for st in (found or []) if st.isDirectory()]


def day_folders(spark: SparkSession, root: str, start: _dt.date, end: _dt.date) -> list[str]:
    """``year=/month=/day=`` folders under ``root`` whose date is in ``[start, end]``."""
    base = root.rstrip("/")
    span = range(start.year, end.year + 1)
    years = "{" + ",".join(map(str, span)) + "}" if len(span) < 100 else "*"
    out = []
    for path in _glob_dirs(spark, f"{base}/year={years}/month=*/day=*"):
        m = _DAY.search(path)
        if m:
            try:
                d = _dt.date(int(m.group(1)), int(m.group(2)), int(m.group(3)))
            except ValueError:
                continue
            if start <= d <= end:
                out.append(path)
    return sorted(out)


def folder_day(path: str) -> _dt.date:
    """The date of a ``year=/month=/day=`` folder."""
    return _dt.date(*map(int, _DAY.search(path).groups()))


def day_runs(days: list[_dt.date]) -> list[tuple[_dt.date, _dt.date]]:
    """Contiguous runs of sorted days, so each run is one range job over exactly those days."""
    runs: list[tuple[_dt.date, _dt.date]] = []
    for d in days:
        if runs and (d - runs[-1][1]).days == 1:
            runs[-1] = (runs[-1][0], d)
        else:
            runs.append((d, d))
    return runs


def date_folders(spark: SparkSession, root: str, start: _dt.date, end: _dt.date) -> list[str]:
    """``snapshot_date=`` folders under ``root`` in ``[start, end]``."""
    out = []
    for path in _glob_dirs(spark, f"{root.rstrip('/')}/snapshot_date=*"):
        m = _DATE.search(path)
        if m and start.isoformat() <= m.group(1) <= end.isoformat():
            out.append(path)
    return sorted(out)


def fact_days(spark: SparkSession, root: str, start: _dt.date, end: _dt.date) -> dict[_dt.date, str]:
    """Day folders inside month folders under ``root`` in ``[start, end]``, by day."""
    out = {}
    for path in _glob_dirs(spark, f"{root.rstrip('/')}/snapshot_month=*/snapshot_date=*"):
        m = _DATE.search(path)
        if m and start.isoformat() <= m.group(1) <= end.isoformat():
            out[_dt.date.fromisoformat(m.group(1))] = path
    return out


def month_folders(spark: SparkSession, root: str, start: _dt.date, end: _dt.date) -> list[str]:
    """``snapshot_month=`` folders under ``root`` overlapping ``[start, end]``."""
    lo, hi = start.year * 100 + start.month, end.year * 100 + end.month
    out = []
    for path in _glob_dirs(spark, f"{root.rstrip('/')}/snapshot_month=*"):
        m = _MONTH.search(path)
        if m and lo <= int(m.group(1)) <= hi:
            out.append(path)
    return sorted(out)
