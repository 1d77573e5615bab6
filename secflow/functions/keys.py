"""Keys, document ids and time formatting as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the modelled pipeline.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"          # CAST(TIMESTAMP(3) AS STRING)
DOCUMENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"  # ISO, microseconds, UTC 'Z'
ISO_SECONDS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"          # epoch-millis bucket bounds


def finding_key(tenant_id: Column, asset_id: Column, cve_id: Column) -> Column:
    """``CAST(CONCAT(tenant, '|', asset, '|', cve) AS BYTES)`` (NULL if any part is NULL)."""
    return F.encode(F.concat(tenant_id, F.lit("|"), asset_id, F.lit("|"), cve_id), "UTF-8")


def to_millis_precision(ts: Column) -> Column:
    """``CAST(ts AS TIMESTAMP(3))``: drop sub-millisecond digits."""
    return F.date_trunc("millisecond", ts)


def event_time_text(ts: Column) -> Column:
    """``CAST(CAST(ts AS TIMESTAMP(3)) AS STRING)``."""
    return F.date_format(to_millis_precision(ts), EVENT_TIME_FORMAT)


def parse_event_time(text: Column) -> Column:
    """Lenient parse: ISO with ``T`` or blank separator, optional zone; the basic form without
    separators too.  A full date is required: a bare time or year is junk, and junk or '' -> NULL.

    The form that this library writes (``EVENT_TIME_FORMAT``, known by its length and three of its marks) is cast as
    it is; only other texts pay for patterns.  Both ways give the same instant.
    """
    blank = F.trim(text)
    iso = F.regexp_replace(blank, r"^(\d{4})(\d{2})(\d{2})(?:[T ](\d{2})(\d{2})(\d{2})|$)", "$1-$2-$3T$4:$5:$6")
    iso = F.regexp_replace(iso, "T::$", "")
    rare = F.when(iso.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d|$)"),
                  F.try_to_timestamp(F.regexp_replace(iso, r"^(\S{10}) ", "$1T")))
    common = ((F.char_length(text) == 23) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 11, 1) == " ")
              & (F.substring(text, 20, 1) == "."))
    return F.coalesce(F.when(common, F.try_to_timestamp(text)), rare)


def parse_event_time_sql(col: str) -> str:
    """``parse_event_time`` as SQL text, for statements that a table format runs (MERGE)."""
    iso = (f"regexp_replace(regexp_replace(trim({col}), "
           r"r'^(\d{4})(\d{2})(\d{2})(?:[T ](\d{2})(\d{2})(\d{2})|$)', '$1-$2-$3T$4:$5:$6'), 'T::$', '')")
    return (f"CASE WHEN {iso} RLIKE r'^\\d{{4}}-\\d{{2}}-\\d{{2}}([T ]\\d|$)' "
            f"THEN try_to_timestamp(regexp_replace({iso}, r'^(\\S{{10}}) ', '$1T')) END")


def normalize_event_time(text: Column) -> Column:
    """ISO-8601 UTC text with microseconds and a ``Z`` suffix; unparsable -> NULL.

    A naive time is read as UTC.  An explicit offset is converted to UTC (the
    instant is unchanged), so every document time has the same text form.
    """
    return F.date_format(parse_event_time(text), DOCUMENT_TIME_FORMAT)


def iso_utc_seconds(ts: Column) -> Column:
    return F.date_format(ts, ISO_SECONDS_FORMAT)


def sha256_hex(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


def finding_doc_id(tenant_id: Column, asset_id: Column, cve_id: Column, event_time: Column,
                   predicted_risk: Column) -> Column:
    """sha256 of the five stable fields; an absent field counts as ''."""
    return sha256_hex(*[F.coalesce(c, F.lit("")) for c in
                        (tenant_id, asset_id, cve_id, event_time, predicted_risk)])


def bi_doc_id(window_start: Column, tenant_id: Column, severity: Column, predicted_risk: Column) -> Column:
    """sha256 of window start text and the three bucket keys; a missing key prints as 'None'."""
    return sha256_hex(*[F.coalesce(c, F.lit("None")) for c in
                        (window_start, tenant_id, severity, predicted_risk)])


def change_time(ts_ms: Column) -> Column:
    """CDC change time (epoch millis) as a timestamp."""
    return F.timestamp_millis(ts_ms)
