"""Landed web payloads: JSON envelopes, JSONP look-ups, label responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cells import strip, to_key
from ledgerloom.functions.codes import market_class
from ledgerloom.operators.latest import one_per_group

# Run-summary states and label-error texts.
SAVED, SKIPPED, FAILED = "saved", "skipped", "failed"
SHORT_TEXT = "Insufficient text"
BAD_JSON = "JSON parse failed"
NO_RESPONSE = "No response after retries"
MIN_LABEL_TEXT = 100

# JSON texts that hold no records.
_EMPTY_JSON = ("[]", "{}", "null", '""', "0", "false")

_LOOKUP = "struct<stockInfo:array<struct<stockId:string,code:string,name:string>>>"
_LABELS = "struct<opinion_type:int,is_uncertain:int,going_concern:int,emphasis_of_matter:int>"


def parse_envelopes(
    payloads: DataFrame, record_schema: str, key: str = "stock_id", body: str = "body"
) -> tuple[DataFrame, DataFrame]:
    """Unpack ``{"result": "<JSON array>"}`` bodies.

    Returns the records, one row each under their key and position, and a run
    summary ``key, status, row_count``: saved with records, skipped when there
    are none, failed when the array is missing or unreadable.
    """
    inner = F.get_json_object(F.col(body), "$.result")
    parsed = payloads.select(
        key,
        inner.alias("_inner"),
        F.from_json(inner, f"array<{record_schema}>").alias("_records"),
    )
    compact = F.regexp_replace(F.col("_inner"), r"\s+", "")
    empty = compact.isin(*_EMPTY_JSON)
    count = F.coalesce(F.size("_records"), F.lit(0))
    status = (
        F.when(F.coalesce(empty, F.lit(False)), F.lit(SKIPPED))
        .when(F.col("_records").isNull() | ~F.startswith(compact, F.lit("[")), F.lit(FAILED))
        .otherwise(F.lit(SAVED))
    )
    judged = parsed.withColumn("status", status)
    # A condition inside the generator, as a filter would parse every body twice.
    saved = F.when(F.col("status") == SAVED, F.col("_records"))
    records = judged.select(key, F.posexplode(saved).alias("position", "_record")).select(
        key, "position", "_record.*"
    )
    summary = judged.select(
        key, "status",
        F.when(F.col("status") == SAVED, count).otherwise(F.lit(0)).alias("row_count"),
    )
    return records, summary


def summary_counts(summary: DataFrame) -> DataFrame:
    return summary.groupBy("status").agg(
        F.count("*").alias("keys"), F.sum("row_count").cast("bigint").alias("records")
    )


def jsonp_body(body: Column) -> Column:
    """The JSON between ``callback(`` and its closing bracket; '' without the wrapper."""
    wrapped = strip(body)
    inner = F.regexp_extract(wrapped, r"(?s)\Acallback\((.*+)", 1)
    return F.regexp_replace(inner, r"\);?\z", "")


def parse_jsonp_lookup(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Look-up responses to rows ``seq, position, stock_code, stock_id, name, market``.

    One code that is not a whole number discards its whole response.
    """
    info = F.from_json(jsonp_body(F.col(body)), _LOOKUP)["stockInfo"]
    good = F.forall(
        "_info", lambda item: strip(item["code"]).rlike(r"\A[+-]?[0-9]+\z")
    )
    rows = payloads.select("seq", info.alias("_info")).select(
        "seq", F.posexplode(F.when(good, F.col("_info"))).alias("position", "_item")
    )
    code = to_key(F.col("_item.code"))
    return rows.select(
        "seq", "position",
        code.alias("stock_code"),
        F.col("_item.stockId").alias("stock_id"),
        F.col("_item.name").alias("name"),
        market_class(code).alias("market"),
    )


def first_seen(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in request order."""
    return one_per_group(df, [key], order)


def normalize_labels(
    responses: DataFrame, min_chars: int = MIN_LABEL_TEXT, body: str = "body"
) -> DataFrame:
    """Label responses to one row per file with an error text or labels.

    Rows in error carry the defaults NULL, 1, 0, 0.
    """
    labels = F.from_json(F.col(body), _LABELS, {"mode": "PERMISSIVE"})
    # from_json gives a struct of NULLs, not NULL, for text it cannot read.
    readable = F.try_parse_json(F.col(body)).isNotNull() & F.startswith(
        strip(F.col(body)), F.lit("{")
    )
    error = (
        F.when(F.coalesce(F.col("text_len"), F.lit(0)) < min_chars, F.lit(SHORT_TEXT))
        .when(F.col(body).isNull(), F.lit(NO_RESPONSE))
        .when(~readable, F.lit(BAD_JSON))
    )
    judged = responses.select("filename", error.alias("error"), labels.alias("_labels"))

    def value(name: str, default: int | None) -> Column:
        return (
            F.when(F.col("error").isNull(), F.col(f"_labels.{name}"))
            .otherwise(F.lit(default).cast("int"))
            .alias(name)
        )

    return judged.select(
        "filename", "error",
        value("opinion_type", None),
        value("is_uncertain", 1),
        value("going_concern", 0),
        value("emphasis_of_matter", 0),
    )


def label_summary(labels: DataFrame) -> DataFrame:
    """Counts over the rows without error."""
    good = labels.where(F.col("error").isNull())

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    return good.agg(
        F.count_if(F.col("opinion_type") == 1).alias("qualified"),
        F.count_if(F.col("opinion_type") == 2).alias("adverse"),
        F.count_if(F.col("opinion_type") == 3).alias("disclaimer"),
        total("is_uncertain").alias("uncertain"),
        total("going_concern").alias("going_concern"),
        total("emphasis_of_matter").alias("emphasis_of_matter"),
    )
