from thermalis.operators.hotspots import hotspots, thresholds
from thermalis.sources import settle
from thermalis.streaming import hotspot_stream, stream_obs, write_alerts


def test_new_files_add_their_alerts(spark, obs_of, tmp_path):
    def batch(month, values):
        return obs_of([("a", f"2003-{month:02d}-{i + 1:02d}", 30.0, 29.0, None, v) for i, v in enumerate(values)])

    paths = [str(tmp_path / name) for name in ("obs", "alerts", "state")]
    first, second = batch(1, [float(v) for v in range(20)]), batch(2, [50.0, 1.0, 18.5])
    limits = settle(thresholds(first), "limits")
    seen = first.limit(0)
    for part in (first, second):
        part.write.mode("append").parquet(paths[0])
        seen = seen.unionByName(part)
        alerts = hotspot_stream(stream_obs(spark, paths[0]), limits)
        write_alerts(alerts, paths[1], paths[2], once=True).awaitTermination()
        want = hotspots(seen, limits)
        got = spark.read.schema(alerts.schema).parquet(paths[1])
        assert got.exceptAll(want).isEmpty() and got.count() == want.count() > 0
    assert got.count() == 4
