"""What was asked for against what has landed: the requests to send again.

The chunk plan says what each series needs; the landed pages say what came.  A chunk is
whole when its good pages run from page 0 without a gap and the last one is shorter than the
venue's page limit (a full last page leaves open whether more follows).  Every other chunk
comes back as a request with the page to go on from.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .payloads import PAGE_REJECTS, candle_rows

WHOLE = ("landed", "empty")


def page_states(pages: DataFrame, layout_col: str = "exchange", keys=("exchange", "base")) -> DataFrame:
    """(keys, chunk_no, page_no, good, n_rows): a page is good when it could be decoded (an empty one too); a page that
    landed more than once counts as its best copy."""
    rows = candle_rows(pages, layout_col)
    return rows.groupBy(*keys, "chunk_no", "page_no").agg(
        F.bool_or(~F.coalesce(F.col("reject_reason").isin(*PAGE_REJECTS), F.lit(False))).alias("good"),
        F.count_if(F.col("pos").isNotNull()).alias("n_rows"))


def ledger(plan: DataFrame, pages: DataFrame, page_limit: int | None = None, layout_col: str = "exchange",
           keys=("exchange", "base")) -> DataFrame:
    """The plan with n_pages, n_bad_pages, n_rows, status and resume_page per chunk.

    ``status``: landed; empty (answered, no rows); missing (nothing came); rejected (a page cannot be decoded); page_gap (a page
    between two others is missing); open_end (the last page is full).  ``resume_page`` is the first page
    that is not there in good order, NULL for a whole chunk."""
    state = page_states(pages, layout_col, keys)
    # the pages of a chunk are few: its minutes over the page limit
    per_chunk = state.groupBy(*keys, "chunk_no").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count_if(~F.col("good")).alias("n_bad_pages"),
        F.sum("n_rows").alias("n_rows"), F.max("page_no").cast("long").alias("_last"),
        F.max_by("n_rows", "page_no").alias("_last_rows"),
        F.collect_set(F.when(F.col("good"), F.col("page_no").cast("long"))).alias("_good"))
    open_end = F.lit(False) if page_limit is None else F.col("_last_rows") >= page_limit
    first_absent = F.array_min(F.array_except(F.sequence(F.lit(0).cast("long"), F.col("_last") + 1), F.col("_good")))
    joined = plan.join(per_chunk, [*keys, "chunk_no"], "left")
    status = (F.when(F.col("n_pages").isNull(), F.lit("missing")).when(F.col("n_bad_pages") > 0, F.lit("rejected"))
              .when(first_absent <= F.col("_last"), F.lit("page_gap")).when(open_end, F.lit("open_end"))
              .when(F.col("n_rows") == 0, F.lit("empty")).otherwise(F.lit("landed")))
    out = joined.withColumn("status", status)
    resume = F.when(~F.col("status").isin(*WHOLE), F.coalesce(first_absent, F.lit(0)))
    counts = [F.coalesce(F.col(x), F.lit(0)).cast("long").alias(x) for x in ("n_pages", "n_bad_pages", "n_rows")]
    return out.select(*plan.columns, *counts, "status", resume.cast("long").alias("resume_page"))


def requests_again(plan: DataFrame, pages: DataFrame, page_limit: int | None = None, layout_col: str = "exchange",
                   keys=("exchange", "base")) -> DataFrame:
    """The chunks of the plan that are not whole, with the reason and the page to go on from."""
    return ledger(plan, pages, page_limit, layout_col, keys).where(~F.col("status").isin(*WHOLE))
