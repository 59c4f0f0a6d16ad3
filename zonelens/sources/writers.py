"""Tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.functions.hosts import join_list
from zonelens.operators.rows import to_expanded_rows, to_json_documents, to_result_rows

DELTA_COLUMNS = ("domain", "is_active", "last_seen_ts", "dns_sig", "mx_regdom", "mx_ips")


def write_results(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON-text results."""
    to_result_rows(records).write.mode(mode).parquet(path)


def write_expanded(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Flattened records (A10)."""
    to_expanded_rows(records).write.mode(mode).parquet(path)


def write_entities(domains: DataFrame, ips: DataFrame, edges: DataFrame, base: str, mode: str = "overwrite") -> None:
    """The three entity tables."""
    base = base.rstrip("/")
    domains.write.mode(mode).parquet(f"{base}/entity_domain")
    ips.write.mode(mode).parquet(f"{base}/entity_ip")
    edges.write.mode(mode).parquet(f"{base}/entity_edge")


def write_retries(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Records to look up again."""
    again = records.filter(F.col("status") == "needs_retry")
    to_result_rows(again).write.mode(mode).parquet(path)


def append_activity_delta(delta: DataFrame, path: str, batch: int | None = None) -> None:
    """Append changed domains to the activity log (A13); nothing is written where nothing changed.

    With a batch number the rows lie below ``batch_id=<n>``, and a batch that runs again replaces its own folder.
    """
    rows = delta.select(*DELTA_COLUMNS).persist()
    try:
        if batch is not None:
            # Also where nothing changed: a first try may have left rows.
            rows.write.mode("overwrite").option("header", True).csv(f"{path}/batch_id={batch}")
        elif not rows.isEmpty():
            rows.write.mode("append").option("header", True).csv(path)
    finally:
        rows.unpersist()


def write_ptr(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """ip, ptr, rcode, ttl."""
    rows.select("ip", "ptr", "rcode", "ttl").write.mode(mode).parquet(path)


def flat_mx_hosts(rows: DataFrame) -> DataFrame:
    """Mail-host table with pipe-joined addresses."""
    return rows.select(
        "host",
        join_list(F.col("a_ips")).alias("a_ips"),
        "a_rcode",
        "a_ttl",
        join_list(F.col("aaaa_ips")).alias("aaaa_ips"),
        "aaaa_rcode",
        "aaaa_ttl",
    )


def write_mx_hosts(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Resolved mail hosts."""
    flat_mx_hosts(rows).write.mode(mode).parquet(path)


def write_banners(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Classified greetings."""
    rows.write.mode(mode).parquet(path)


def write_json_documents(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line."""
    to_json_documents(df).write.mode(mode).text(path)
