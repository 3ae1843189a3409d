"""Exact quantiles, the carried sweep and pruned scans."""

import math
import random

from pyspark.sql import functions as F

from duskwatch.operators.quantiles import nearest_ranks
from duskwatch.operators.sweep import nearest_preceding
from duskwatch.sources import logs


def test_nearest_ranks_against_sorted_lists(spark):
    rng = random.Random(4)
    groups = {
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 30) for _ in range(500)], "same": [7.0] * 300, "ties": [float(rng.randint(-3, 3)) for _ in range(400)],
        "one": [0.0], "close": [1e9 + rng.random() for _ in range(300)], "none": [],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in [*vs, None]], "g string, v double")
    percents = [1, 5, 50, 95, 99, 100]
    got = {(r["g"], r["percent"]): r["value"] for r in nearest_ranks(df, ["g"], "v", percents).collect()}
    want = {(g, p): sorted(vs)[max(math.ceil(p * len(vs) / 100), 1) - 1] for g, vs in groups.items() if vs for p in percents}
    assert got == want
    some = sorted(groups["ties"] + groups["close"])
    whole = nearest_ranks(df.filter(F.col("g").isin("ties", "close")), [], "v", [50, 95])
    assert {r["percent"]: r["value"] for r in whole.collect()} == {p: some[math.ceil(p * len(some) / 100) - 1] for p in (50, 95)}


def test_nearest_point_over_days(spark):
    rng = random.Random(9)
    day = 86_400_000_000
    points = [rng.randrange(40 * day) for _ in range(25)] + [5 * day, 5 * day - 1]
    probes = [rng.randrange(-day, 60 * day) for _ in range(200)] + points
    df = nearest_preceding(spark.createDataFrame([(p,) for p in probes], "ts_us bigint"), spark.createDataFrame([(p,) for p in points], "ts_us bigint"), floor_us=1000)
    got = sorted((r["ts_us"], r["point_us"]) for r in df.collect() if r["point_us"] is not None)
    assert got == sorted((t, max(p for p in points if p <= t - 1000)) for t in probes if any(p <= t - 1000 for p in points))


def test_a_date_opens_its_folder_only(spark, tmp_path):
    for date in ("2026-05-01", "2026-05-02"):
        for host in ("pi", "edge"):
            folder = tmp_path / "raw" / "cowrie" / f"date={date}" / f"host={host}"
            folder.mkdir(parents=True)
            (folder / "a.log").write_text(f"{date} {host}\n\n")
    lines = logs.read_partitioned(spark, f"file://{tmp_path}/raw/cowrie").filter(F.col("date") == "2026-05-02")
    assert sorted(tuple(r) for r in lines.select("line", "kind", "date", "host").collect()) == [("2026-05-02 edge", "event", "2026-05-02", "edge"), ("2026-05-02 pi", "event", "2026-05-02", "pi")]
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
