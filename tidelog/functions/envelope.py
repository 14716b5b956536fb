"""JSON envelope of a published line: encode, strict decode, stored row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.clock import event_time, time_of_day
from tidelog.functions.text import log_level, log_message, log_timestamp
from tidelog.schema import LOG_RECORD

FIELDS = tuple(LOG_RECORD.fieldNames())
_EXTRAS = {"pos": "bigint", "log_date": "string"}
_KINDS = {**dict.fromkeys(FIELDS, "variant"), **_EXTRAS, "_digest": "string"}
_WRAPPED = f"array<struct<{','.join(f'{name}:{kind}' for name, kind in _KINDS.items())}>>"
_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def parse_line(
    lines: DataFrame,
    value: str = "value",
    file_name: str = "file_name",
    mode: str = "full",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Raw lines to published records; ``keep`` carries further columns along."""
    line = F.col(value)
    return lines.select(
        *keep,
        log_timestamp(line).alias("timestamp"),
        log_level(line).alias("level"),
        log_message(line, mode).alias("message"),
        F.col(file_name).alias("filename"),
    )


def encode(extras: Sequence[str] = (), pretty: bool = False) -> Column:
    """Envelope text of a record.

    ``extras`` (a line position, a date) travel as additional fields, which a
    strict reader of the four mandatory ones ignores.
    """
    options = {"pretty": "true"} if pretty else {}
    return F.to_json(F.struct(*FIELDS, *extras), options)


def decode(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``valid`` and the envelope's fields to rows of JSON text.

    A row is valid only if its text is exactly one JSON object whose four
    mandatory fields are all JSON strings; of a repeated field the last one
    counts. Fields of rejected rows are NULL.

    The parser alone would convert other kinds to text and accept text after the
    object. So the mandatory fields are read as variants, which keep their kind,
    and the text is wrapped in an array closed by an object with its own digest:
    any tail, comma or bracket in the text moves or hides that last element. The
    parse sits in a one-row ``inline``: a later filter on ``valid`` is not pushed
    below it, so a text is parsed once however many columns use it.
    """
    text = F.col(value)
    digest = F.sha2(text, 256)
    wrapped = F.concat(F.lit("["), text, F.lit(',{"_digest":"'), digest, F.lit('"}]'))
    parse = F.from_json(wrapped, _WRAPPED, _STRICT)
    parsed = df.select("*", F.inline(F.array(F.struct(parse.alias("_parts"), digest.alias("_expected")))))
    split = parsed.select(
        *df.columns,
        F.get("_parts", F.lit(0)).alias("_m"),
        ((F.size("_parts") == 2) & (F.get("_parts", F.lit(1))["_digest"] == F.col("_expected"))).alias("_whole"),
    )
    valid = F.col("_whole")
    for name in FIELDS:
        valid = valid & (F.schema_of_variant(F.col(f"_m.{name}")) == "STRING")
    marked = split.withColumn("valid", F.coalesce(valid, F.lit(False)))
    wanted = {name: F.try_variant_get(f"_m.{name}", "$", "string") for name in FIELDS}
    wanted.update({name: F.col(f"_m.{name}") for name in _EXTRAS})
    return marked.select(
        *df.columns,
        "valid",
        *[F.when(F.col("valid"), column).alias(name) for name, column in wanted.items()],
    )


def log_key(origin: Column, date: Column | None = None) -> Column:
    """Key of a stored row: the same line of the same origin and date always gets
    the same key, so a replay cannot duplicate it, and equal text at two places or
    on two days stays two rows."""
    known = F.lit("") if date is None else date
    parts = [F.col("file_name"), known, origin, F.col("timestamp"), F.col("log_type"), F.col("log_message")]
    return F.sha2(F.concat_ws("\x01", *[F.coalesce(part.cast("string"), F.lit("")) for part in parts]), 256)


def to_log_data(records: DataFrame, day: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Decoded records to stored rows.

    The event time joins the record's own ``log_date`` (else ``day``) with its time
    of day; an unknown date or malformed time gives NULL. The origin in the key is
    the line's position, else the message's place in its topic, else its landed file
    and which of that file's equal records it is (``msg_copy``). The date in the key is
    the one that places the row, so a key is only ever looked up under its own date,
    and the same message dated otherwise is another row.
    """

    def own(name: str, kind: str) -> Column:
        return (F.col(name) if name in records.columns else F.lit(None)).cast(kind)

    place = F.when(
        own("msg_offset", "bigint").isNotNull(),
        F.concat_ws(":", own("msg_partition", "string"), own("msg_offset", "string")),
    )
    copy = F.when(
        own("msg_copy", "bigint").isNotNull(),
        F.concat_ws("#", own("msg_file", "string"), own("msg_copy", "string")),
    )
    date = F.coalesce(own("log_date", "string"), F.lit(day).cast("string"))
    rows = records.select(
        *keep,
        F.col("filename").alias("file_name"),
        "timestamp",
        F.col("level").alias("log_type"),
        F.col("message").alias("log_message"),
        event_time(date, time_of_day(F.col("timestamp"))).alias("event_ts"),
        own("pos", "bigint").alias("src_pos"),
        F.coalesce(own("pos", "string"), place, copy).alias("_origin"),
        date.alias("_date"),
    )
    return rows.select(
        *keep,
        log_key(F.col("_origin"), F.col("_date")).alias("log_id"),
        "file_name",
        "timestamp",
        "log_type",
        "log_message",
        "event_ts",
        "src_pos",
    )
