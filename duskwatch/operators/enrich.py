"""Geo lookup and password redaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.functions.text import redaction_marker
from duskwatch.operators.addresses import address_range_join
from duskwatch.operators.joins import BROADCAST_ROWS, ip_range_join, lookup_left


def geo_enrich(events: DataFrame, geo_ranges: DataFrame) -> DataFrame:
    """Add ``country, asn, asn_org``; a given non-null country wins and brings its own asn and org.

    Ranges are IPv4 numbers (``lo, hi``) or texts of both families (``first, last``), see ``address_range_join``.
    """
    both = "first" in geo_ranges.columns
    ranges = geo_ranges.select(
        *(("first", "last") if both else ("lo", "hi")),
        F.col("country").alias("__country"), F.col("asn").alias("__asn"), F.col("asn_org").alias("__org"),
    )
    joined = (address_range_join if both else ip_range_join)(events, "src_ip", ranges)
    if "given_country" in events.columns:
        given = F.col("given_country").isNotNull()
        country = F.when(given, F.col("given_country")).otherwise(F.col("__country"))
        asn = F.when(given, F.col("given_asn")).otherwise(F.col("__asn"))
        org = F.when(given, F.col("given_asn_org")).otherwise(F.col("__org"))
    else:
        country, asn, org = F.col("__country"), F.col("__asn"), F.col("__org")
    keep = [
        c
        for c in events.columns
        if c not in ("given_country", "given_asn", "given_asn_org", "country", "asn", "asn_org")
    ]
    return joined.select(
        *keep, country.alias("country"), asn.cast("bigint").alias("asn"), org.alias("asn_org")
    )


def classify_passwords(events: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Replace ``password`` by its public form and add the private ``password_raw``.

    A dictionary word is public as it is. Any other text is redacted to its length and
    kept only in ``password_raw``.
    """
    words = dictionary.select(F.col("word").alias("password"), F.lit(True).alias("__known"))
    joined = lookup_left(
        events, words, "password", spread_by=["session", "ts"], broadcast_rows=BROADCAST_ROWS
    )
    hidden = F.col("password").isNotNull() & F.col("__known").isNull()
    return (
        joined.withColumn("password_raw", F.when(hidden, F.col("password")))
        .withColumn("password", F.when(hidden, redaction_marker(F.col("password"))).otherwise(F.col("password")))
        .drop("__known")
    )
