"""Registry of plans: name -> callable(spark, sf_dir) and name -> SQL oracle.

Each plan is a thin adapter (driver tables -> operator input shape -> library
call); the operator logic lives in ``tidewater.operators``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.plans import (chat_plans, docs_plans, etl_plans, events_plans, items_plans,
                             media_lake_plans, metrics_plans, stream_plans, table_plans, oracle_chat, oracle_docs, oracle_etl,
                             oracle_events, oracle_items, oracle_media_lake, oracle_metrics, oracle_streams)

Plan = Callable[[SparkSession, str], DataFrame]


def _plans_of(module, names) -> dict[str, Plan]:
    return {n: getattr(module, n) for n in names}


def queries() -> dict[str, Plan]:
    out: dict[str, Plan] = {}
    out.update(_plans_of(metrics_plans, [
        "stream_metrics", "stream_metrics_hourly", "windowed_metrics", "error_alerts",
        "archive_partitions", "stream_audit", "stream_quarantine", "stream_dirty_metrics", "stream_dirty_audit",
         "metrics_live", "archive_tiers",
    ]))
    out.update(_plans_of(etl_plans, ["etl_daily", "etl_stage_all", "etl_load", "etl_rejects", "etl_audit"]))
    out.update(_plans_of(events_plans, ["order_state", "inventory_state", "notification_outbox",
                                        "routed_counts", "event_quarantine"]))
    out.update(_plans_of(items_plans, ["item_catalog", "items_active_page", "item_delete_counts",
                                       "latest_event_per_user", "user_recent_events",
                                       "order_customer_lookup", "orders_by_status"]))
    out.update(_plans_of(chat_plans, ["chat_senders", "chat_fanout", "chat_room_deliveries",
                                      "chat_room_history", "chat_presence", "chat_membership",
                                      "chat_room_users", "chat_message_rows"]))
    out.update(_plans_of(docs_plans, ["doc_text", "doc_overflow", "doc_language", "doc_language_accuracy",
                                      "doc_sentiment", "doc_entities", "doc_key_phrases",
                                      "doc_translation_worklist", "doc_results", "doc_result_page",
                                      "doc_part_results"]))
    out.update(_plans_of(media_lake_plans, ["media_results", "media_notification_counts",
                                            "lake_ingest_summary", "lake_category_stats", "lake_count",
                                            "lake_sample", "lake_partition_query", "lake_two_batches",
                                            "lake_partition_prune"]))
    out.update(_plans_of(stream_plans, ["stream_record_metrics", "windowed_stream_append", "order_state_stream",
                                        "inventory_state_stream", "chat_presence_stream"]))
    out.update(_plans_of(table_plans, ["order_table_upserts"]))
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for mod in (oracle_metrics, oracle_etl, oracle_events, oracle_items, oracle_chat, oracle_docs,
                oracle_media_lake, oracle_streams):
        out.update({k: v.strip() for k, v in mod.SQL.items()})
    return out
