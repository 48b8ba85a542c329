"""Item catalogue as a fold of a command log: create, partial update, delete
(E4, C4 via ``keyed.delete_keys``, B16 via ``keyed.list_rows``).

Commands: ``(id, op, body VARIANT, seq, at)``.  ``create`` replaces the whole
item, ``update`` sets only the fields present in its body (an explicit null
sets null) and creates the item when it does not exist (Q14), ``delete``
removes it.  For each field the value comes from the latest command that
either sets the field or resets the item (create / delete) -- one
aggregate with partial combine, no window and no self-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.core import has_key
from tidewater.operators.quality import split_valid

# Item fields with their create-time defaults (None = no
# default: absent unless given).
FIELDS = [
    ("name", "string", None),
    ("description", "string", ""),
    ("status", "string", "active"),
    ("price", "decimal(38,18)", None),
    ("tags", "array<string>", None),
]


def validate_commands(cmds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A create needs ``name``; ids are required."""
    return split_valid(cmds, {
        "missing_id": F.col("id").isNull() | (F.col("id") == ""),
        "missing_name": (F.col("op") == "create") & ~has_key("body", "name"),
        "missing_seq": F.col("seq").isNull(),
        "unknown_op": ~F.col("op").isin("create", "update", "delete"),
    })


def _field_value(op: Column, name: str, type_: str, default) -> tuple[Column, Column]:
    present = has_key("body", name)
    value = F.try_variant_get("body", f"$.{name}", type_)
    if default is not None:
        on_create = F.when(present, value).otherwise(F.lit(default).cast(type_))
    else:
        on_create = F.when(present, value)
    v = (F.when(op == "create", on_create)
         .when(op == "update", value))
    # Which commands decide the field: resets and updates that carry it.
    decides = (op != "update") | present
    return v, decides


def fold_items(cmds: DataFrame) -> DataFrame:
    """Current items.  Output: ``id``, the FIELDS, ``created_at``
    (time of the create that the item stems from; NULL for items born from
    an update) and ``updated_at`` (time of the last command)."""
    op = F.col("op")
    seq = F.col("seq")
    aggs = []
    for name, type_, default in FIELDS:
        v, decides = _field_value(op, name, type_, default)
        aggs.append(F.max_by(v, F.when(decides, seq)).alias(name))
    resets = op != "update"
    aggs += [
        F.max_by(F.when(op == "create", F.col("at")), F.when(resets, seq)).alias("created_at"),
        F.max_by(F.col("at"), seq).alias("updated_at"),
        F.max_by(op, seq).alias("_last_op"),
    ]
    folded = cmds.groupBy("id").agg(*aggs)
    return folded.filter(F.col("_last_op") != "delete").drop("_last_op")
