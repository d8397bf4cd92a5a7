"""Press releases: codes to ids, pending ids, payloads, summary, ignore list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import payloads as P
from ledgerloom.operators import worklist as W
from ledgerloom.operators.joins import keep_listed
from ledgerloom.session import settle


def stock_id_mapping(lookups: DataFrame) -> DataFrame:
    """First-seen row per stock id from landed look-up responses ``seq, body``."""
    rows = P.parse_jsonp_lookup(lookups)
    return P.first_seen(rows, "stock_id", ["seq", "position"])


def ingest_releases(
    lookups: DataFrame, payloads: DataFrame, ignore: DataFrame, existing: DataFrame,
    record_schema: str,
) -> dict[str, DataFrame]:
    """One round: which ids are pending, what arrived for them, the next ignore list.

    ``payloads`` holds landed responses as ``seq, stock_id, body``. What several
    later steps read (mapping, pending ids, summary) is settled on the way.
    """
    mapping = settle(stock_id_mapping(lookups), "mapping")
    full = mapping.where(F.col("stock_id") != "").select(
        "seq", "position", F.col("stock_id").alias("id")
    )
    pending, counts = W.pending_list(full, ignore, existing)
    pending = settle(pending, "pending").orderBy("seq", "position")
    arrived = keep_listed(payloads, pending, [("stock_id", "id")])
    keyed = arrived.select(F.struct("seq", "stock_id").alias("key"), "body")
    records, summary = P.parse_envelopes(keyed, record_schema, key="key")
    summary = settle(summary.select("key.seq", "key.stock_id", "status", "row_count"), "summary")
    updated, added = W.update_ignore(ignore, summary)
    return {
        "mapping": mapping,
        "pending": pending,
        "counts": counts,
        "records": records.select("key.stock_id", *records.columns[1:]),
        "summary": summary,
        "ignore": updated,
        "added": added,
    }
