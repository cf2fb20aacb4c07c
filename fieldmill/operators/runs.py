"""Fetch outcomes: classification, run metadata, log and failure report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmill.functions.numbers import percentage

# fixed values: exception kinds that have their own class
EXCEPTION_CLASSES = {
    "timeout": "timeout",
    "connection": "network_error",
    "json_decode": "json_parse_error",
}


def _status_class(status: Column) -> Column:
    return (
        F.when(status == 404, "not_found")
        .when(status.between(500, 599), "server_error")
        .when(status.between(400, 499), "client_error")
    )


def error_class(http_status: Column, exception_kind: Column) -> Column:
    """Class of a failed fetch: by status, else by exception kind, else ``unknown``."""
    by_exception = F.when(exception_kind == "http", "client_error")
    for kind, name in EXCEPTION_CLASSES.items():
        by_exception = by_exception.when(exception_kind == kind, name)
    return F.coalesce(_status_class(http_status), by_exception, F.lit("unknown"))


def fetch_outcome(
    source_url: Column, fetched: Column, parsed: Column, unexpected: Column | None = None
) -> Column:
    """``success`` or the step that failed: no address, fetch, parse, anything else."""
    outcome = F.when(F.coalesce(source_url, F.lit("")) == "", "no_main_url")
    if unexpected is not None:
        outcome = outcome.when(F.coalesce(unexpected, F.lit(False)), "unexpected_error")
    return (
        outcome.when(~F.coalesce(fetched, F.lit(False)), "fetch_failed")
        .when(~F.coalesce(parsed, F.lit(False)), "parse_failed")
        .otherwise("success")
    )


def run_metadata(log: DataFrame) -> DataFrame:
    """One row over a log with ``success, n_fields, n_assets`` per entity."""
    ok = F.col("success")
    totals = log.agg(
        F.count(F.lit(1)).alias("total_entities"),
        F.count_if(ok).alias("successful"),
        F.coalesce(F.sum(F.when(ok, F.col("n_fields"))), F.lit(0)).alias("total_fields"),
        F.coalesce(F.sum(F.when(ok, F.col("n_assets"))), F.lit(0)).alias("total_assets"),
    )
    done, everything = F.col("successful"), F.col("total_entities")
    return totals.select(
        "total_entities",
        "successful",
        (everything - done).alias("failed"),
        F.coalesce(F.try_divide(done.cast("double"), everything.cast("double")), F.lit(0.0)).alias(
            "success_rate"
        ),
        percentage(done, everything).alias("success_percentage"),
        "total_fields",
        F.coalesce(
            F.try_divide(F.col("total_fields").cast("double"), done.cast("double")), F.lit(0.0)
        ).alias("avg_fields_per_entity"),
        F.coalesce(F.floor(F.try_divide("total_fields", "successful")), F.lit(0))
        .cast("bigint")
        .alias("avg_fields_whole"),
        "total_assets",
    )


def asset_count(assets: Column) -> Column:
    """Number of non-empty assets of a document."""
    present = [assets[name].isNotNull().cast("int") for name in ("flag", "map", "locator_map")]
    images = (F.coalesce(F.size(assets["images"]), F.lit(0)) > 0).cast("int")
    return present[0] + present[1] + present[2] + images


def log_entries(log: DataFrame) -> DataFrame:
    """Per entity: status, duration, source, and the error or the field count."""
    ok = F.col("success")
    return log.select(
        F.col("slug").alias("entity"),
        F.col("scraped_at").alias("timestamp"),
        F.when(ok, "success").otherwise("failed").alias("status"),
        "duration_seconds",
        "source_url",
        F.when(~ok, F.coalesce("error", F.lit("unknown"))).alias("error"),
        F.when(~ok, F.coalesce("error_details", F.lit(""))).alias("error_details"),
        F.when(ok, F.col("n_fields")).alias("fields_count"),
    )


def failure_counts(log: DataFrame) -> DataFrame:
    """Failed entities per error."""
    return (
        log.filter(~F.col("success"))
        .groupBy(F.coalesce("error", F.lit("unknown")).alias("error"))
        .agg(F.count(F.lit(1)).alias("n_entities"))
    )


def failed_entities(log: DataFrame) -> DataFrame:
    """All failed entities with their error, as rows."""
    return log.filter(~F.col("success")).select(
        F.col("slug").alias("entity"), F.coalesce("error", F.lit("unknown")).alias("error")
    )


def first_failures(log: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` failed entities of the report."""
    return failed_entities(log).orderBy("entity", "error").limit(n)
