"""Chat: presence, message-to-connection joins and room fan-out
(C1, C2, C3, C5, D7, E5, B22, B25).

Connections ``(connection_id, room, user_id, connected_at, ttl)``; messages
``(message_id, connection_id, room, type, message, ts)``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.core import has_key, lit_ts
from tidewater.operators import keyed

CONNECTION_TTL_S = 86400
MESSAGE_TTL_S = 86400 * 7
# Defaults for a connection without room / user.
DEFAULT_ROOM = "default"
DEFAULT_USER = "anonymous"


def connection_rows(df: DataFrame) -> DataFrame:
    """Connection rows with defaults and the 24 h expiry."""
    return df.select(
        "connection_id",
        F.coalesce("room", F.lit(DEFAULT_ROOM)).alias("room"),
        F.coalesce("user_id", F.lit(DEFAULT_USER)).alias("user_id"),
        "connected_at",
        (F.unix_seconds(F.col("connected_at").cast("timestamp")) + F.lit(CONNECTION_TTL_S)).alias("ttl"),
    )


def message_rows(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Stored messages from VARIANT bodies ``(message_id, connection_id,
    at, body)``.  A default stands in only for an absent key; an explicit null
    stays null (Q5).  Rows expire after 7 days."""
    def field(key: str, default: str):
        return F.when(has_key(body, key), F.try_variant_get(body, f"$.{key}", "string")).otherwise(F.lit(default))

    return bodies.select(
        "message_id", "connection_id", field("room", DEFAULT_ROOM).alias("room"), field("type", "message").alias("type"),
        field("message", "").alias("message"), "at",
        (F.unix_seconds(F.col("at").cast("timestamp")) + F.lit(MESSAGE_TTL_S)).alias("ttl"))


def with_sender(messages: DataFrame, connections: DataFrame) -> DataFrame:
    """C1 in one join: messages with the sender's ``user_id``, or with an
    ``error`` where the connection is unknown.  Room comes from the message
    (Q15)."""
    conn = connections.select("connection_id", F.col("user_id").alias("_user"), F.lit(True).alias("_hit"))
    hit = F.col("_hit").isNotNull()
    return (messages.join(conn, "connection_id", "left")
            .withColumns({"user_id": F.when(hit, F.coalesce("_user", F.lit(DEFAULT_USER))),
                          "error": F.when(~hit, F.lit("Connection not found"))}).drop("_user", "_hit"))


def attach_sender(messages: DataFrame, connections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages with their sender, messages whose connection is unknown)."""
    both = with_sender(messages, connections)
    return both.filter(F.col("error").isNull()).drop("error"), both.filter(F.col("error").isNotNull()).drop("user_id")


def fan_out(messages: DataFrame, connections: DataFrame) -> DataFrame:
    """Every ``type='message'`` row to every connection of its room,
    sender included (other types are stored, not delivered: Q15).  A
    many-to-many equi-join on room: a hot room is split by AQE's skew-join
    handling (the message side is cut, the room's connections replicated)."""
    msgs = messages.filter(F.col("type") == "message").select("message_id", "room")
    conns = connections.select("room", F.col("connection_id").alias("to_connection"))
    return msgs.join(conns, "room", "inner")


def deliveries_per_room(messages: DataFrame, connections: DataFrame) -> DataFrame:
    """C2 totals without materialising pairs: both sides are counted per
    room first, then the two small aggregates are joined."""
    m = messages.filter(F.col("type") == "message").groupBy("room").agg(F.count(F.lit(1)).alias("messages"))
    c = connections.groupBy("room").agg(F.count(F.lit(1)).alias("connections"))
    return (m.join(c, "room", "left")
            .select("room", "messages", F.coalesce("connections", F.lit(0)).alias("connections"),
                    (F.col("messages") * F.coalesce("connections", F.lit(0))).alias("deliveries")))


def drop_stale(connections: DataFrame, failures: DataFrame) -> DataFrame:
    """Remove connections whose delivery failed."""
    return connections.join(failures.select("connection_id").distinct(), "connection_id", "left_anti")


def room_history(messages: DataFrame, n: int) -> DataFrame:
    """E5: the ``n`` newest messages per room, newest first; key
    ``(room, ts, message_id)`` so equal times do not collide (Q15c)."""
    return keyed.top_k(messages, ["room"], [F.col("ts").desc(), F.col("message_id").desc()], n,
                       salt=F.col("message_id"))


def present(marks: DataFrame, as_of: str | datetime) -> DataFrame:
    """The live connections ``(connection_id, room, since)`` at the clock,
    the users of each room among them."""
    clock = lit_ts(as_of)
    seen = marks.filter(F.col("ts") <= clock)
    per_conn = (seen.groupBy("connection_id")
                .agg(F.max_by(F.struct("ts", "room"), F.when(F.col("kind") == 0, F.struct("ts", "kind")))
                     .alias("c"),
                     F.max(F.when(F.col("kind") == 1, F.col("ts"))).alias("d")))
    live = per_conn.filter(
        F.col("c").isNotNull()
        & (F.unix_seconds(F.col("c.ts").cast("timestamp")) + F.lit(CONNECTION_TTL_S)
           > F.unix_seconds(clock.cast("timestamp")))
        & (F.col("d").isNull() | (F.col("d") < F.col("c.ts"))))
    return live.select("connection_id", F.col("c.room").alias("room"), F.col("c.ts").alias("since"))


def presence(marks: DataFrame, as_of: str | datetime) -> DataFrame:
    """D7 + B22: live connections per room at ``as_of``.

    ``marks``: ``(connection_id, ts, kind, room)`` with kind 0 = connect,
    1 = disconnect.  A connection is live when its latest connect is less
    than 24 h old and no disconnect came after it.  Two partial aggregates.
    """
    return present(marks, as_of).groupBy("room").agg(F.count(F.lit(1)).alias("active_connections"))


def membership_at(marks: DataFrame, messages: DataFrame) -> DataFrame:
    """The room of the sender's membership valid at each message time.

    A membership runs from a connect until the next disconnect of the same
    connection or 24 h, whichever is first.  As-of join on the connection
    key, without a range join: marks and messages are merged and ordered per
    (connection, day); the last connect / disconnect seen before a message
    decides.  Each mark is copied into its own and the next day (a membership
    lasts 24 h at most), so hot connections are split by day and the answer
    is exact; one connection's day is sorted in one task.  Output: every message with ``room`` (NULL when no
    membership was valid).
    """
    width = F.expr("INTERVAL 1 DAY")
    b = F.date_trunc("day", "ts")
    m = marks.select("connection_id", "ts", "kind", "room", F.lit(None).cast("long").alias("message_id"))
    m = m.withColumn("_b", F.explode(F.array(b.cast("timestamp_ntz"), (b + width).cast("timestamp_ntz"))))
    msg = messages.select("connection_id", "ts", F.lit(2).alias("kind"), F.lit(None).cast("string").alias("room"),
                          "message_id").withColumn("_b", b.cast("timestamp_ntz"))
    both = m.unionByName(msg)
    w = (Window.partitionBy("connection_id", "_b").orderBy("ts", "kind", "message_id")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last_c = F.last(F.when(F.col("kind") == 0, F.struct("ts", "room")), ignorenulls=True).over(w)
    last_d = F.last(F.when(F.col("kind") == 1, F.col("ts")), ignorenulls=True).over(w)
    tagged = both.select("*", last_c.alias("_c"), last_d.alias("_d")).filter(F.col("kind") == 2)
    valid = (F.col("_c").isNotNull()
             & (F.col("_d").isNull() | (F.col("_d") < F.col("_c.ts")))
             & (F.col("ts") < F.col("_c.ts") + F.expr(f"INTERVAL {CONNECTION_TTL_S} SECONDS")))
    return tagged.select("message_id", "connection_id", "ts", F.when(valid, F.col("_c.room")).alias("room"))
