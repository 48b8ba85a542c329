"""Column-level helpers: decoding, JSON/variant access, time parsing, money.

All helpers return JVM-side ``Column`` expressions (no Python UDFs).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def once(df: DataFrame) -> DataFrame:
    """The same rows, with every derived column worked out once a row.

    The optimiser moves a filter below the projection that derives its columns and
    repeats the whole derivation in it, for each use.  It moves nothing below a
    generator, so one that gives each row back as it is keeps them apart.  Filters
    that a scan could use belong before this.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


# ---------------------------------------------------------------- decoding


def strict_json(text: Column | str) -> Column:
    """The variant of a text that is exactly one JSON document, else NULL.

    The parser stops after the first document, so the text is parsed inside
    an array and inside an object: what follows the document would have to
    close both, and a second document makes the array longer.
    """
    c = _c(text)
    listed = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    held = F.try_parse_json(F.concat(F.lit('{"k":'), c, F.lit("}")))
    one = (F.size(listed.try_cast("array<variant>")) == 1) & held.isNotNull()
    return F.when(F.coalesce(one, F.lit(False)), F.try_variant_get(listed, "$[0]", "variant"))


def decode_base64_json(data: Column | str) -> Column:
    """base64 text -> UTF-8 -> JSON variant; NULL at the first failing step.

    ``try_to_binary(.., 'base64')`` is used instead of ``unbase64`` because
    the latter returns bytes for junk input instead of failing.
    """
    raw = F.try_to_binary(_c(data), F.lit("base64"))
    # A binary->string cast keeps the bytes; try_validate_utf8 rejects bad ones.
    return strict_json(F.try_validate_utf8(raw.cast("string")))


def decode_stage(data: Column | str, decoded: Column | str) -> Column:
    """Name of the first decoding stage that fails, else NULL; ``decoded`` is
    the column made by ``decode_base64_json``."""
    raw = F.try_to_binary(_c(data), F.lit("base64"))
    return (F.when(_c(decoded).isNotNull(), F.lit(None).cast("string"))
            .when(raw.isNull(), F.lit("bad_base64"))
            .when(F.try_validate_utf8(raw.cast("string")).isNull(), F.lit("bad_utf8"))
            .otherwise(F.lit("bad_json")))


def vmap(v: Column | str) -> Column:
    """Variant object viewed as map<string, variant> (NULL if not an object)."""
    return _c(v).try_cast("map<string, variant>")


def has_key(v: Column | str, key: str) -> Column:
    """Key presence in a variant object; true even for an explicit JSON null
    (a JSON null is a non-NULL variant).  A path lookup, no map is built."""
    return F.try_variant_get(_c(v), _path(key), "variant").isNotNull()


def vget(v: Column | str, path: str, type_: str) -> Column:
    return F.try_variant_get(_c(v), path, type_)


def variant_fields(v: Column | str, path: str = "$", **types: str) -> Column:
    """Fields of a variant object by name, as one structure; NULL if there is no object.

    An absent field is NULL, a JSON null too unless its type is ``variant``.  A path
    that leads nowhere costs Spark an exception each time; this looks at the fields
    that are there, once for all names.
    """
    fields = ", ".join(f"`{k}`: {t}" for k, t in types.items())
    return F.try_variant_get(_c(v), path, f"struct<{fields}>")


def is_json_null(v: Column | str, key: str) -> Column:
    """Key present and explicitly null."""
    return F.coalesce(F.is_variant_null(F.try_variant_get(_c(v), _path(key), "variant")), F.lit(False))


def _path(key: str) -> str:
    return "$['" + key.replace("'", "\\'") + "']"


# ---------------------------------------------------------------- time

def parse_iso(ts: Column | str) -> Column:
    """ISO-8601 text with 'Z', an offset or no zone, 'T' or a blank between
    date and time -> TIMESTAMP (bare values are UTC: the session zone is).
    A full date is required; a time alone would take today's date."""
    c = F.trim(_c(ts))
    return F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ]|$)"), F.try_to_timestamp(c))


def iso_string(ts: Column | str) -> Column:
    """TIMESTAMP/TIMESTAMP_NTZ -> 'yyyy-MM-ddTHH:mm:ss' text (UTC)."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss")


def lit_ts(value: str | datetime) -> Column:
    """A fixed clock value as TIMESTAMP_NTZ (driver tables use NTZ); a
    datetime with a zone is taken to UTC."""
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc)
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp_ntz(F.lit(value))


def epoch_seconds(ts: Column | str) -> Column:
    """Seconds since epoch of a TIMESTAMP or TIMESTAMP_NTZ (read as UTC)."""
    return F.unix_seconds(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


# ---------------------------------------------------------------- numbers


def money(c: Column | str) -> Column:
    """Exact decimal view of a 2-digit money / metric value."""
    return _c(c).cast("decimal(18,2)")


def money_sum(c: Column | str) -> Column:
    """Order-independent sum: exact decimal addition, then DOUBLE."""
    return F.sum(money(c)).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or NULL."""
    return F.when(den > 0, num.cast("double") / den.cast("double"))


# ---------------------------------------------------------------- strings


def file_extension(name: Column | str) -> Column:
    """Lower-cased text after the last '.', '' when there is none."""
    n = F.lower(_c(name))
    return F.when(F.instr(n, ".") > 0, F.element_at(F.split(n, r"\."), -1)).otherwise(F.lit(""))


def basename(path: Column | str) -> Column:
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


# ---------------------------------------------------------------- internal


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c

