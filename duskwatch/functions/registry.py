"""The scalar helpers as Spark SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from duskwatch.functions.net import IPV4_PATTERN, IPV6_PATTERN

TECHNIQUE_CASE = (
    "CASE WHEN unique_usernames >= 10 AND failed + succeeded > 0 THEN 'credential_stuffing' "
    "WHEN failed >= 5 AND unique_usernames = 1 THEN 'brute_force' "
    "WHEN duration < 2.0D AND failed + succeeded = 0 THEN 'scanner' ELSE 'other' END"
)


def _literal(pattern: str) -> str:
    return "r'" + pattern + "'"


def _definitions() -> dict[str, str]:
    v4, v6 = _literal(IPV4_PATTERN), _literal(IPV6_PATTERN)
    octets = " + ".join(f"CAST(get(split(ip, '[.]'), {i}) AS BIGINT) * {256 ** (3 - i)}L" for i in range(4))
    return {
        "is_ip_address(ip STRING) RETURNS BOOLEAN": f"ip RLIKE {v4} OR ip RLIKE {v6}",
        "ip_as_long(ip STRING) RETURNS BIGINT": f"CASE WHEN ip RLIKE {v4} THEN {octets} END",
        "iso_micros(t STRING) RETURNS BIGINT": "unix_micros(try_to_timestamp(t))",
        "redaction_mark(secret STRING) RETURNS STRING": "concat('<filtered:len=', length(secret), '>')",
        "redaction_len(marker STRING) RETURNS INT": (
            "try_cast(regexp_extract(marker, r'^<filtered:len=(\\d+)>$', 1) AS INT)"
        ),
        "technique_label(duration DOUBLE, failed BIGINT, succeeded BIGINT, unique_usernames BIGINT) RETURNS STRING": (
            TECHNIQUE_CASE
        ),
    }


def register_sql_functions(spark: SparkSession) -> None:
    for signature, body in _definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
