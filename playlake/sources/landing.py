"""Landed HTTP response bodies, shaped into rows.

The fetching itself is not part of the package; whatever lands the raw bodies
writes a table of them, and these functions turn that table into bronze rows
or catalogue rows inside Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.schemas import ENVELOPE_DDL, OUTCOME_DDL, PAGE_DDL
from playlake.session import scratch_path


def unwrap_envelopes(
    landed: DataFrame,
    body_col: str = "body",
    requested_col: str | None = "requested_appid",
    fetched_at_col: str = "fetched_at",
) -> DataFrame:
    """``{"<appid>": {"success": .., "data": {..}}}`` -> bronze rows.

    With ``requested_col`` only the entry under the requested id counts (an absent id
    gives nothing, like an empty object); without it every entry is returned. Only
    successful entries survive. Output: ``appid, success, fetched_at, data``, where
    ``data`` is the payload's whole JSON text (``sources.bronze.write_bronze_lines`` lands
    it unchanged, ``payload`` reads the silver fields).

    The body is parsed once per row: the object's entries are emitted by a generator,
    and filters above a generator's output cannot be substituted back into its input
    (a filter on a projected ``from_json`` would be, and would parse every body twice).
    """
    entries = landed.select(
        *([F.col(requested_col).cast("bigint").alias("_requested")] if requested_col else []),
        F.col(fetched_at_col).alias("fetched_at"),
        F.explode(F.from_json(F.col(body_col), ENVELOPE_DDL)).alias("_k", "_e"),
    )
    if requested_col:
        entries = entries.where(F.col("_k") == F.col("_requested").cast("string"))
        appid = F.col("_requested")
    else:
        appid = F.col("_k").try_cast("bigint")
    return entries.where(F.coalesce(F.col("_e.success"), F.lit(False))).select(
        appid.alias("appid"), F.lit(True).alias("success"), "fetched_at", F.col("_e.data").alias("data")
    )


def attempt_outcomes(
    landed: DataFrame,
    body_col: str = "body",
    requested_col: str = "requested_appid",
    date_col: str = "snapshot_date",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """L3: one row per landed attempt, ``(date_col, success)`` and the columns of ``keep``.

    A body that is not JSON, that lacks the requested id, or whose entry is unsuccessful or
    says nothing counts as an error, as each was an attempt.
    """
    entry = F.try_element_at(F.from_json(F.col(body_col), OUTCOME_DDL), F.col(requested_col).cast("string"))
    return landed.select(date_col, *keep, F.coalesce(entry["success"], F.lit(False)).alias("success"))


def reconcile_targets(
    targets: DataFrame,
    attempts: DataFrame,
    id_col: str = "appid",
    attempt_id_col: str = "requested_appid",
    date_col: str = "snapshot_date",
) -> DataFrame:
    """What became of each planned target, ``(date_col, id_col, outcome, n_attempts)``.

    ``attempts`` is landed bodies with their ``success`` (``attempt_outcomes(..., keep=...)``). All
    attempts of one app on one day are one fetch: ``ok`` if any of them succeeded, whatever came
    before, else ``err``. A target without a body is ``unanswered``, an app fetched without a
    target ``unplanned`` (also when its id or date is null). Targets given twice count once;
    those without id are ignored.

    Attempts are reduced map-side before the join, so an app retried a million times is a row
    a task; both sides are hashed by (day, app).
    """
    planned = targets.select(F.col(date_col), F.col(id_col).cast("bigint").alias(id_col)).where(F.col(id_col).isNotNull()).distinct()
    tried = attempts.groupBy(F.col(date_col), F.col(attempt_id_col).cast("bigint").alias(id_col)).agg(
        F.bool_or(F.coalesce(F.col("success"), F.lit(False))).alias("_ok"), F.count(F.lit(1)).alias("_n"))
    both = planned.withColumn("_planned", F.lit(True)).join(tried, [date_col, id_col], "full_outer")
    outcome = (
        F.when(F.col("_planned").isNull(), F.lit("unplanned"))
        .when(F.col("_ok"), F.lit("ok"))
        .when(F.col("_n").isNotNull(), F.lit("err"))
        .otherwise(F.lit("unanswered"))
    )
    return both.select(date_col, id_col, outcome.alias("outcome"), F.coalesce("_n", F.lit(0).cast("bigint")).alias("n_attempts"))


def target_counts(outcomes: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    """A day's report over ``reconcile_targets``: each target counts once.

    ``n_total`` targets are ``n_ok`` and ``n_err``; the unanswered are errors too and are
    counted apart as well. ``n_retried`` targets took more than one attempt, ``n_recovered`` of them
    came out ok. Unplanned fetches are no targets.
    """
    is_ = lambda *names: F.col("outcome").isin(*names)
    again = F.col("n_attempts") > 1
    return outcomes.groupBy(date_col).agg(
        F.count_if(is_("ok")).alias("n_ok"),
        F.count_if(is_("err", "unanswered")).alias("n_err"),
        F.count_if(is_("ok", "err", "unanswered")).alias("n_total"),
        F.count_if(is_("unanswered")).alias("n_unanswered"),
        F.count_if(is_("unplanned")).alias("n_unplanned"),
        F.count_if(again & ~is_("unplanned")).alias("n_retried"),
        F.count_if(again & is_("ok")).alias("n_recovered"),
    )


def _page_problem(s: str, body_missing: Column, stop: Column, first: Column, n_pages: Column, last: Column) -> Column:
    """What is wrong with a snapshot's pages, as text; NULL when they are whole."""
    where = F.concat(F.lit("catalogue snapshot "), F.coalesce(F.col(s).cast("string"), F.lit("NULL")), F.lit(": "))
    return F.concat(
        where,
        F.when(body_missing, F.lit("a page does not parse"))
        .when(stop.isNull(), F.lit("the last page is missing"))
        .when(last > stop, F.lit("pages follow the last page"))
        .when((first > 0) | (n_pages < last - first + 1), F.lit("page numbers have a gap")),
    )


def parsed_pages(landed: DataFrame, snapshot_col: str, body_col: str = "body", page_col: str = "page_no") -> DataFrame:
    """Landed pages parsed once, into a written table: ``snapshot_col, page_no, parsed, have_more, apps``."""
    # The corrupt-record field tells a body that is no page from one without apps.
    page = F.from_json(F.col(body_col), f"{PAGE_DDL}, _corrupt_record string").alias("p")
    path = scratch_path(landed.sparkSession, "pages")
    landed.select(snapshot_col, F.col(page_col).alias("page_no"), F.explode(F.array(page)).alias("p")).select(
        snapshot_col,
        "page_no",
        (F.col("p").isNotNull() & F.col("p._corrupt_record").isNull()).alias("parsed"),
        F.coalesce(F.col("p.response.have_more_results"), F.lit(False)).alias("have_more"),
        F.coalesce(F.col("p.response.apps"), F.array()).alias("apps"),
    ).write.parquet(path)
    return landed.sparkSession.read.parquet(path)


def page_report(pages: DataFrame, snapshot_col: str) -> DataFrame:
    """Per snapshot of ``parsed_pages`` (pages numbered from 0): its stop page and what is wrong with it (NULL: nothing).

    The stop page is the first that says no more results follow (a missing flag says so too).
    """
    good = F.col("parsed")
    stats = pages.groupBy(snapshot_col).agg(
        F.min(F.when(good & ~F.col("have_more"), F.col("page_no"))).alias("stop"),
        F.min("page_no").alias("first"),
        F.max("page_no").alias("last"),
        F.count_distinct("page_no").alias("n_pages"),
        F.bool_or(~good).alias("broken"),
    )
    c = F.col
    return stats.withColumn("problem", _page_problem(snapshot_col, c("broken"), c("stop"), c("first"), c("n_pages"), c("last")))


def unwrap_pages(
    landed: DataFrame,
    snapshot_col: str,
    body_col: str = "body",
    page_col: str = "page_no",
    strict: bool = True,
) -> DataFrame:
    """Catalogue pages -> one row per app, each snapshot's pages concatenated.

    A snapshot's pages count up to and including its own stop page. ``strict`` fails the
    job when a page does not parse, a page number or the last page is missing, or pages
    follow the last one; without it those pages are left out, and ``page_report`` names
    the snapshots concerned. A page without ``apps`` is empty. Each body is parsed once.
    """
    pages = parsed_pages(landed, snapshot_col, body_col, page_col)
    report = page_report(pages, snapshot_col).select(F.col(snapshot_col).alias("_snapshot"), "stop", "problem")
    kept = pages.join(report, F.col(snapshot_col).eqNullSafe(F.col("_snapshot")))
    if strict:
        checked = F.when(F.col("problem").isNotNull(), F.raise_error(F.col("problem")).cast("bigint")).otherwise(F.col("page_no"))
        kept = kept.withColumn("page_no", checked)
    kept = kept.where(F.col("stop").isNull() | (F.col("page_no") <= F.col("stop")))
    return kept.select(snapshot_col, "page_no", F.inline("apps"))


def page_chain(landed: DataFrame, snapshot_col: str, body_col: str = "body", after_col: str = "after") -> DataFrame:
    """The order of catalogue pages that carry no number, ``(snapshot_col, after_col, page_no, problem)``.

    A page was asked for after a cursor (null or 0: the first page) and names the cursor of the
    next one, ``last_appid``. So pages are a list per snapshot, linked by cursor, and their numbers
    are ranked by pointer doubling: every page points to the one before it, then twice as far in each
    round, so a snapshot of n pages takes as many joins as n has binary digits, whatever else is
    landed. Bodies are read once, for their cursor; only cursors are shuffled.

    The same page landed twice counts once. ``problem`` names what keeps a page from a number: no
    page ends at its cursor, several pages do, pages of different content follow one cursor,
    or cursors that lead round.
    """
    spark, zero = landed.sparkSession, F.lit(0).cast("bigint")
    after = F.coalesce(F.col(after_col).cast("bigint"), zero).alias("after")
    last = F.get_json_object(body_col, "$.response.last_appid").try_cast("bigint").alias("last")
    links = landed.select(F.col(snapshot_col).alias("s"), after, last, F.xxhash64(body_col).alias("h"))
    path = scratch_path(spark, "page-links")
    links.distinct().write.parquet(path)
    links = spark.read.parquet(path)
    ends = links.where("last is not null").select("s", "after", "last").distinct().groupBy("s", F.col("last").alias("after")).agg(
        F.min("after").alias("before"), F.count(F.lit(1)).alias("enders"))
    links = links.groupBy("s", "after").agg(F.count(F.lit(1)).alias("texts"))
    same = F.col("a.s").eqNullSafe(F.col("b.s"))
    first = F.col("a.after") == 0
    linked = links.alias("a").join(ends.alias("b"), same & (F.col("a.after") == F.col("b.after")), "left").select(
        "a.s", "a.after", F.when(~first, F.col("b.before")).alias("to"), F.when(first, 0).otherwise(1).cast("bigint").alias("far"),
        F.when(F.col("a.texts") > 1, F.lit("several pages follow cursor "))
        .when(~first & F.col("b.before").isNull(), F.lit("no page ends at cursor "))
        .when(~first & (F.col("b.enders") > 1), F.lit("several pages end at cursor ")).alias("why"))
    # A page with a problem is an end of the list, which the pages behind it inherit.
    broken = F.col("why").isNotNull()
    chain = linked.select("s", "after", F.when(~broken, F.col("to")).alias("to"), F.when(~broken, F.col("far")).otherwise(0).alias("far"),
                          F.concat("why", F.col("after").cast("string")).alias("problem"))
    most = links.groupBy("s").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0  # one scalar
    for _ in range(most.bit_length()):
        path = scratch_path(spark, "page-chain")
        chain.write.parquet(path)
        chain = spark.read.parquet(path)
        chain = chain.alias("a").join(chain.alias("b"), same & (F.col("a.to") == F.col("b.after")), "left").select(
            "a.s", "a.after", F.col("b.to").alias("to"), (F.col("a.far") + F.coalesce("b.far", zero)).alias("far"),
            F.coalesce("a.problem", "b.problem").alias("problem"))
    round_ = F.when(F.col("to").isNotNull(), F.concat(F.lit("cursors lead round at "), F.col("after").cast("string")))
    problem = F.coalesce("problem", round_)
    return chain.select(F.col("s").alias(snapshot_col), F.col("after").alias(after_col),
                        F.when(problem.isNull(), F.col("far")).alias("page_no"), problem.alias("problem"))


def numbered_pages(
    landed: DataFrame, snapshot_col: str, body_col: str = "body", after_col: str = "after", strict: bool = True
) -> DataFrame:
    """Landed pages with their ``page_no`` by cursor, for ``unwrap_pages``: each page once.

    ``strict`` fails the job with the snapshot and the link that is broken; without it such pages are
    left out, and ``page_chain`` names them.
    """
    chain = page_chain(landed, snapshot_col, body_col, after_col).withColumnsRenamed({snapshot_col: "_s", after_col: "_after"})
    after = F.coalesce(F.col(after_col).cast("bigint"), F.lit(0).cast("bigint"))
    once = landed.groupBy(F.col(snapshot_col), after.alias(after_col)).agg(F.min(body_col).alias(body_col))
    both = once.join(chain, F.col(snapshot_col).eqNullSafe(F.col("_s")) & (F.col(after_col) == F.col("_after")))
    number = F.col("page_no")
    if strict:
        where = F.concat(F.lit("catalogue snapshot "), F.coalesce(F.col(snapshot_col).cast("string"), F.lit("NULL")), F.lit(": "), F.col("problem"))
        number = F.when(F.col("problem").isNotNull(), F.raise_error(where).cast("bigint")).otherwise(number)
    return both.select(snapshot_col, number.alias("page_no"), body_col).where("page_no is not null")


def fetch_outcomes(attempts: DataFrame, date_col: str = "snapshot_date", success_col: str = "success") -> DataFrame:
    """Ok / err / total fetch attempts per day (``count_if``, one pass)."""
    ok = F.coalesce(F.col(success_col), F.lit(False))
    return attempts.groupBy(date_col).agg(
        F.count_if(ok).alias("n_ok"),
        F.count_if(~ok).alias("n_err"),
        F.count(F.lit(1)).alias("n_total"),
    )
