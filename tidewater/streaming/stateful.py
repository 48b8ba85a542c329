"""State kept by Spark's state store: orders, inventory, presence.

A few values a key are in RocksDB, which Spark checkpoints by batch and restores
on a restart: the cost of a batch follows the keys it touches, not the keys there
are.  Orders and inventory are folds, so Spark's streaming aggregation keeps them:
each task first combines its own rows of a key, so a key that holds much of a
stream sends one row a task, and no key is handed to Python.  Presence needs
timers, so a processor of its own keeps it.

A stream emits the rows it changed; the state as a whole is read from the
checkpoint by ``order_table``, ``inventory_table`` and ``state_table``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewater.operators import chat

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Rows of a state are alike, so that blocks of more rows pack better.
_STORE = {"spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
          "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "16"}


def use_state_store(spark: SparkSession) -> None:
    """The state store these processors need, its files small unless the session says otherwise."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    for key, value in _STORE.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def _names(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


def last_in_batch(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key in each batch a task is handed, by ``order``.

    Ties keep the later row.  A batch has a bounded number of rows, so this holds
    no more than it; the same key may remain once a batch.
    """

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.sort_values(order, kind="stable").drop_duplicates(keys, keep="last")

    return rows.mapInPandas(pick, rows.schema)


# ---------------------------------------------------------------- I3

ORDER_CHANGE = "order_id string, kind string, customer_id string, items string, total string, created_at string, seq string"
ORDER_FIELDS = ["customer_id", "items", "total", "created_at"]
INVENTORY_CHANGE = "item_id string, quantity string, updated_at string, seq string"


def _folded(changes: DataFrame, key: str, last: dict[str, tuple[list[str], Column]]) -> DataFrame:
    """Per key the last fields of each kind, and the batch they came in, as a stream in update mode.

    ``last`` has the fields and the order of each kind; rows without an order don't
    count for it.  A batch's clock is the same for all its rows, also when it is
    run again, so it tells which rows this batch has changed.
    """
    rows = changes.withColumn("_at", F.current_timestamp())
    kinds = [F.max_by(F.struct(*fields, "_at"), order).alias(kind) for kind, (fields, order) in last.items()]
    now = F.lit(False)
    for kind in last:
        now = now | F.coalesce(F.col(kind)["_at"] == F.current_timestamp(), F.lit(False))
    return rows.groupBy(key).agg(*kinds).where(now)


def order_stream(changes: DataFrame) -> DataFrame:
    """Changed order rows from a stream of ``ORDER_CHANGE`` rows; any type that orders may be the sequence.

    Folds an order's changes (E3) in whatever order batches bring them: the last
    ``created`` sets all fields, the last change of any kind the status.
    """
    created = F.col("kind") == "created"
    rows = changes.select(*_names(ORDER_CHANGE)).withColumn("status", F.when(created, "processing").otherwise("completed"))
    folded = _folded(rows, "order_id", {"any": (["seq", "status"], F.col("seq")), "made": (ORDER_FIELDS, F.when(created, F.col("seq")))})
    return folded.select("order_id", "any.seq", "any.status", *[f"made.{c}" for c in ORDER_FIELDS])


def order_table(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(order_id, status, fields) of an order stream as its last batch left it."""
    fields = ", ".join(f"{c}: string" for c in ORDER_FIELDS)
    s = _aggregates(spark, checkpoint, {"any": "struct<seq: string, status: string, at: timestamp>", "made": f"struct<{fields}, at: timestamp>"})
    return s.select("order_id", "any.status", *[f"made.{c}" for c in ORDER_FIELDS])


def inventory_stream(changes: DataFrame) -> DataFrame:
    """Changed inventory rows from a stream of ``INVENTORY_CHANGE`` rows, likewise: the last change of an item."""
    rows = changes.select(*_names(INVENTORY_CHANGE))
    folded = _folded(rows, "item_id", {"any": (["quantity", "updated_at", "seq"], F.col("seq"))})
    return folded.select("item_id", "any.quantity", "any.updated_at", "any.seq")


def inventory_table(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(item_id, quantity, updated_at) of an inventory stream as its last batch left it."""
    s = _aggregates(spark, checkpoint, {"any": "struct<quantity: string, updated_at: string, seq: string, at: timestamp>"})
    return s.select("item_id", "any.quantity", "any.updated_at")


# ---------------------------------------------------------------- I4

PRESENCE_STATE = "connected_us long, room string, disconnected_us long"
PRESENCE_EVENT = "connection_id string, room string, event string, at timestamp"


class PresenceProcessor(StatefulProcessor):
    """A connection's last connect and disconnect, forgotten when they can't matter.

    A connect runs out after ``chat.CONNECTION_TTL_S``: a timer in event time ends
    it, without a new event of that connection.  A disconnect is remembered until
    the watermark has passed it, since an older connect may still arrive.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.presence = handle.getValueState("presence", PRESENCE_STATE)

    def _emit(self, key, room, event, us) -> Row:
        return Row(connection_id=key[0], room=room, event=event, at=pd.Timestamp(us, unit="us", tz="UTC").to_pydatetime())

    def _set_timer(self, state) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        ends = [us for us in (state[0] is not None and state[0] + chat.CONNECTION_TTL_S * 1_000_000, state[2]) if us]
        self.handle.registerTimer(-(-min(ends) // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = self.presence.get()
        state = list(now) if now is not None else [None, None, None]
        was = _live(state)
        for r in sorted(rows, key=lambda r: (r.us, r.kind)):
            if r.kind == 0 and (state[0] is None or r.us >= state[0]):
                state[:2] = r.us, r.room
            if r.kind == 1 and (state[2] is None or r.us >= state[2]):
                state[2] = r.us
        self.presence.update(tuple(state))
        self._set_timer(state)
        if _live(state):
            yield self._emit(key, state[1], "connected", state[0])
        elif was:
            yield self._emit(key, state[1], "disconnected", state[2])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self.presence.get()
        if now is None:
            return
        passed, state = expiredTimerInfo.getExpiryTimeInMs() * 1000, list(now)
        ended = state[0] is not None and state[0] + chat.CONNECTION_TTL_S * 1_000_000 <= passed
        if ended:
            if _live(state):
                yield self._emit(key, state[1], "expired", state[0] + chat.CONNECTION_TTL_S * 1_000_000)
            state[:2] = None, None
        if state[2] is not None and state[2] <= passed:
            if state[0] is not None and state[0] <= state[2]:
                state[:2] = None, None      # disconnected, and no older connect can come
            state[2] = None
        if state[0] is None and state[2] is None:
            self.presence.clear()
        else:
            self.presence.update(tuple(state))
            self._set_timer(state)


def _live(state) -> bool:
    return state[0] is not None and (state[2] is None or state[2] < state[0])


def presence_stream(marks: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Connects, disconnects and expiries from a stream of ``(connection_id, ts, kind, room)``.

    Marks later than ``delay`` behind the newest are dropped and counted by Spark.
    """
    rows = (marks.select("connection_id", F.col("ts").cast("timestamp").alias("ts"), "kind", "room")
            .withColumn("us", F.unix_micros("ts")).withWatermark("ts", delay))
    return rows.groupBy("connection_id").transformWithState(PresenceProcessor(), PRESENCE_EVENT, "Append", "EventTime")


# ---------------------------------------------------------------- reading state


def state_table(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """(key..., state...) of a query's state as its last batch left it."""
    use_state_store(spark)
    rows = spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
    return rows.select("key.*", "value.*")


def _aggregates(spark: SparkSession, checkpoint: str, kinds: dict[str, str]) -> DataFrame:
    """(key..., kinds...) of the ``max_by`` aggregates that a query keeps.

    Spark names what it keeps of an aggregate alike for all of them, so its value and
    its order are told apart by their places.
    """
    use_state_store(spark)
    places = ", ".join(f"`{k}`: {ddl}, `{k}_order`: string" for k, ddl in kinds.items())
    rows = spark.read.format("statestore").load(checkpoint)
    return rows.select("key.*", F.col("value").cast(f"struct<{places}>").alias("_v")).select("*", "_v.*").drop("_v")


def present_at(spark: SparkSession, checkpoint: str, as_of) -> DataFrame:
    """Live connections per room at a clock that the stream has reached."""
    s = state_table(spark, checkpoint, "presence")
    clock = F.unix_micros(F.lit(as_of).cast("timestamp_ntz").cast("timestamp"))
    live = (F.col("connected_us").isNotNull() & (F.col("connected_us") + chat.CONNECTION_TTL_S * 1_000_000 > clock)
            & (F.col("disconnected_us").isNull() | (F.col("disconnected_us") < F.col("connected_us"))))
    return s.where(live).groupBy("room").agg(F.count(F.lit(1)).alias("active_connections"))
