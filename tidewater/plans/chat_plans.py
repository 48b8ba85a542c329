"""Registered plans for the chat application.

Rooms and messages from ``conversations``: room = conversation, a message per
turn, one connection per (conversation, role) for the user and assistant
roles; system turns have type ``notice`` and no connection of their own.
Presence and point-in-time membership from ``events``: ``signup`` connects
user ``u`` to room ``props.k``, ``error`` disconnects it, ``click`` events
are messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import chat
from tidewater.plans.common import EVENTS_AS_OF, t, ts_text


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "conversations")
    return c.select(
        F.concat_ws("-", "conv_id", "turn").alias("message_id"),
        F.concat_ws(":", "conv_id", "role").alias("connection_id"),
        F.concat(F.lit("room-"), F.col("conv_id")).alias("room"),
        F.when(F.col("role") == "system", F.lit("notice")).otherwise(F.lit("message")).alias("type"),
        F.col("text").alias("message"),
        F.col("turn").alias("ts"),
    )


def _connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "conversations").filter(F.col("role") != "system").select("conv_id", "role").distinct()
    return c.select(
        F.concat_ws(":", "conv_id", "role").alias("connection_id"),
        F.concat(F.lit("room-"), F.col("conv_id")).alias("room"),
        F.col("role").alias("user_id"))


def chat_senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stored message with its sender, or the not-found error."""
    return (chat.with_sender(_messages(spark, sf_dir), _connections(spark, sf_dir))
            .select("message_id", "room", "user_id", "error"))


def chat_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery row per (message, room connection)."""
    found, _ = chat.attach_sender(_messages(spark, sf_dir), _connections(spark, sf_dir))
    return chat.fan_out(found, _connections(spark, sf_dir))


def chat_room_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 totals per room from pre-aggregated sides."""
    found, _ = chat.attach_sender(_messages(spark, sf_dir), _connections(spark, sf_dir))
    return chat.deliveries_per_room(found, _connections(spark, sf_dir))


def chat_room_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: the 3 newest messages of every room."""
    h = chat.room_history(_messages(spark, sf_dir), 3)
    return h.select("room", "message_id", "rank")


def _marks_and_clicks(spark: SparkSession, sf_dir: str):
    ev = t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    conn_id = F.col("user_id").cast("string").alias("connection_id")
    marks = ev.filter(F.col("event_type").isin("signup", "error")).select(
        conn_id, "ts",
        F.when(F.col("event_type") == "signup", F.lit(0)).otherwise(F.lit(1)).alias("kind"),
        F.when(F.col("event_type") == "signup",
               F.concat(F.lit("room-"), F.get_json_object("props", "$.k"))).alias("room"))
    clicks = ev.filter(F.col("event_type") == "click").select(
        conn_id, "ts", F.col("event_id").alias("message_id"))
    return marks, clicks


def chat_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 + B22: live connections per room at the clock."""
    marks, _ = _marks_and_clicks(spark, sf_dir)
    return chat.presence(marks, EVENTS_AS_OF)


def chat_room_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users present in each room at the clock."""
    marks, _ = _marks_and_clicks(spark, sf_dir)
    return chat.present(marks, EVENTS_AS_OF).select("room", F.col("connection_id").alias("user_id"), ts_text("since").alias("since"))


def chat_message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored messages; every fourth lacks its room, the one after it has
    a null room."""
    e = t(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    case = F.col("event_id") % 4
    room = F.when(case == 0, F.lit("")).when(case == 1, F.lit('"room":null,')).otherwise(F.lit('"room":"r",'))
    body = F.parse_json(F.concat(F.lit("{"), room, F.lit('"message":"'), "event_type", F.lit('"}')))
    rows = e.select(F.col("event_id").cast("string").alias("message_id"), F.col("user_id").cast("string").alias("connection_id"),
                    F.col("ts").alias("at"), body.alias("body"))
    return chat.message_rows(rows).withColumn("at", ts_text("at"))


def chat_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Room of the membership valid at each click (NULL if none)."""
    marks, clicks = _marks_and_clicks(spark, sf_dir)
    return chat.membership_at(marks, clicks).select("message_id", "connection_id", "room")
