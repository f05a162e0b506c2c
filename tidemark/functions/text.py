"""Keys, JSON forms, time texts and artifact names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How timestamps are written in JSON, and how time and date texts look.
RFC3339_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
DAY = "yyyy-MM-dd"
# RFC 3339 date-time with an offset or Z.
RFC3339_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def composite_key(*parts: Column) -> Column:
    return F.concat_ws(":", *parts)


def online_value(value: Column, timestamp: Column) -> Column:
    """JSON value of an online entry: ``{"val": ..., "timestamp": ...}``."""
    return F.to_json(
        F.struct(value.alias("val"), F.date_format(timestamp, RFC3339_MICROS).alias("timestamp"))
    )


def rfc3339(text: Column) -> Column:
    """Timestamp of an RFC 3339 text; anything else gives null, for the dead letters."""
    return F.when(text.rlike(RFC3339_SHAPE), F.try_to_timestamp(text))


def day_text(date: Column) -> Column:
    return F.date_format(date, DAY)


def sorted_map_json(entries: Column) -> Column:
    """JSON object of a map, keys in ascending order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(entries))))


def result_text(value: Column) -> Column:
    """Six decimals, as the prediction log stores results."""
    return F.format_string("%f", value)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_extension(path: Column) -> Column:
    """Part after the last dot of the file name, empty when there is none."""
    return F.regexp_extract(file_name(path), r"\.([^.]*)$", 1)


def file_stem(path: Column) -> Column:
    """Path without its last extension."""
    return F.regexp_replace(path, r"\.[^./]*$", "")


def is_production_file(path: Column) -> Column:
    return F.endswith(file_stem(path), F.lit("Production"))


def artifact_key(model_id: Column, path: Column) -> Column:
    return F.concat_ws(":", F.lit("model"), model_id, file_extension(path))


def model_location(model_id: Column) -> Column:
    return F.format_string("Model_%s/", model_id)


def production_file(model_id: Column, extension: Column) -> Column:
    return F.format_string("Model_%s/Model_%s_Production.%s", model_id, model_id, extension)


def archive_file(path: Column, number: Column) -> Column:
    """The first ``_Production`` becomes ``_<number>``.

    A version or sequence number takes the place of a random one, so a second run of the job
    writes the same name.
    """
    before = F.substring_index(path, "_Production", 1)
    rest = F.substr(path, F.length(before) + F.lit(len("_Production") + 1))
    return F.when(
        F.contains(path, F.lit("_Production")),
        F.concat(before, F.lit("_"), number.cast("string"), rest),
    ).otherwise(path)
