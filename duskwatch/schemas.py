"""Field lists and struct types of the telemetry shapes."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire fields of a honeypot event. Every scalar is read as text first and cast later:
# captured events carry numbers as text (duration "0.3") and lists where text is usual.
EVENT_FIELDS = (
    "eventid", "timestamp", "src_ip", "session", "sensor",
    "uuid", "protocol", "src_port", "dst_ip", "dst_port", "message",
    "username", "password", "version", "hassh",
    "kexAlgs", "keyAlgs", "encCS", "macCS", "compCS",
    "input", "url", "outfile", "shasum", "duration",
)
REQUIRED_FIELDS = ("eventid", "timestamp", "src_ip", "session", "sensor")
LIST_FIELDS = ("kexAlgs", "keyAlgs", "encCS", "macCS", "compCS")
TRANSPORT_FIELDS = ("fluent_host", "fluent_source")
GIVEN_FIELDS = ("country", "asn", "asn_org")

PROXY_FIELDS = (
    "time", "host", "process", "pid", "client_ip", "client_port", "frontend_port",
    "duration", "bytes_uploaded", "bytes_downloaded", "status",
)

# The columns that may leave the system; password_raw is not among them.
PUBLIC_COLUMNS = (
    "eventid", "session", "src_ip", "ts", "sensor",
    "src_port", "dst_ip", "dst_port", "protocol", "message",
    "username", "password", "input", "url", "shasum", "duration",
    "country", "asn", "asn_org", "correlation_status",
)


def all_strings(names, extra: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in (*names, *extra)])


# Typed attributes of a change record. Lists and maps hold scalars here.
_SCALAR = "S: STRING, N: STRING, BOOL: BOOLEAN, NULL: BOOLEAN"
ATTRIBUTE = f"STRUCT<{_SCALAR}, L: ARRAY<STRUCT<{_SCALAR}>>, M: MAP<STRING, STRUCT<{_SCALAR}>>>"
CHANGE_RECORD = (
    "eventID STRING, eventName STRING, eventSource STRING, "
    f"dynamodb STRUCT<NewImage: MAP<STRING, {ATTRIBUTE}>>"
)
