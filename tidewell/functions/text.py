"""Text and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_key(epoch: Column) -> Column:
    """Epoch seconds as the int ``yyyyMMdd``."""
    return F.date_format(F.timestamp_seconds(epoch.cast("long")), "yyyyMMdd").cast("int")


def hour_of(epoch: Column) -> Column:
    return F.hour(F.timestamp_seconds(epoch.cast("long")))


def hour_of_as_millis(epoch: Column) -> Column:
    """Hour obtained when seconds are taken for milliseconds; kept to reproduce old outputs."""
    return F.hour(F.timestamp_millis(epoch.cast("long")))


def file_stem(name: Column) -> Column:
    """File name up to its first dot; names that start with a dot stay whole."""
    return F.when(F.instr(name, ".") > 1, F.substring_index(name, ".", 1)).otherwise(name)


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^https?://([^/:?#]+)", 1)


def json_string(text: Column) -> Column:
    """A string as a JSON scalar."""
    wrapped = F.to_json(F.struct(text.alias("t")))
    return F.when(text.isNotNull(), F.substring(wrapped, F.lit(6), F.length(wrapped) - 6))


def json_unstring(encoded: Column) -> Column:
    """The string in a JSON scalar."""
    return F.from_json(F.concat(F.lit('{"t":'), encoded, F.lit("}")), "t string")["t"]


def norm_form(name: Column) -> Column:
    """Lower case without punctuation and spaces: an equality key for names."""
    return F.regexp_replace(F.lower(name), r"[\p{Punct}\s]+", "")


def words(text: Column) -> Column:
    """Runs of letters, of any script."""
    return F.filter(F.split(text, r"[^\pL]+"), lambda w: w != "")


def shard_of(key: Column, shards: int) -> Column:
    """Shard number from the first four hex digits of the key's md5."""
    return (F.conv(F.substring(F.md5(key), 1, 4), 16, 10).cast("int") % shards).cast("int")
