import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from roadflux.operators import prep, trips
from roadflux.streaming.segmenter import downsample_stream, segment_stream

PING = "caid string, ping_seq bigint, local_timestamp timestamp, latitude double, longitude double"
T0 = dt.datetime(2024, 1, 10, 6)


def pings(seed=2, users=4, rows=60):
    rnd, out, seq = random.Random(seed), [], 0
    for u in range(users):
        t, lat = T0, 25.6
        for _ in range(rows):
            t += dt.timedelta(seconds=rnd.choice([10, 20, 60, 200, 400, 1900, 20000]))
            lat += rnd.choice([0, 0, 0.0001, 0.003, 0.05])
            out.append((f"u{u}", seq, t, lat, -100.3))
            seq += 1
    return sorted(out, key=lambda r: r[2])


def stream(spark, folder, rows, batches):
    for n in range(batches):
        own = rows[n * len(rows) // batches : (n + 1) * len(rows) // batches]
        spark.createDataFrame(own, PING).coalesce(1).write.parquet(str(folder / f"b{n:02}"))
    return spark.readStream.schema(PING).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(folder))


def run(df, name, batches=None):
    """Until the stream ends, or for one that waits for time-outs for ever, until ``batches`` files are taken."""
    query = df.writeStream.format("memory").queryName(name).outputMode("append")
    if batches is None:
        query = query.trigger(availableNow=True).start()
        query.awaitTermination(60)
    else:
        query, end = query.start(), time.time() + 60
        while time.time() < end and (query.lastProgress is None or query.lastProgress["batchId"] < batches):
            time.sleep(0.2)
    query.stop()


def test_stream_equals_batch_for_finished_days(spark, tmp_path):
    rows = pings()
    run(segment_stream(stream(spark, tmp_path, rows, 5)), "steps_out", 5)
    got = {r.ping_seq: r for r in spark.table("steps_out").collect()}
    batch = spark.createDataFrame(rows, PING).withColumn("local_timestamp", F.col("local_timestamp").cast("timestamp_ntz")).withColumn("date", F.to_date("local_timestamp"))
    want = {r.ping_seq: r for r in trips.assign_trips(prep.travel_times(prep.vectors(batch))).collect()}
    missing = set(want) - set(got)
    assert set(got) <= set(want) and len(missing) <= 4  # each user's last step waits for what comes next
    for seq, r in got.items():
        assert r.trip == want[seq].trip and r.travel_s == want[seq].travel_s
        assert r.speed_kmh == pytest.approx(want[seq].speed_kmh, abs=1e-9)


def test_late_pings_do_not_turn_the_clock_back(spark, tmp_path):
    """A ping of the day before, or of an hour ago, that comes late changes nothing of what is given."""
    rows = pings(seed=8, users=1)
    late = [("u0", 10_000, rows[20][2] - dt.timedelta(days=1), 25.0, -100.0), ("u0", 10_001, rows[20][2] - dt.timedelta(seconds=1), 25.0, -100.0)]
    run(segment_stream(stream(spark, tmp_path / "a", rows, 6)), "plain_out", 6)
    run(segment_stream(stream(spark, tmp_path / "b", [*rows[:30], *late, *rows[30:]], 6)), "late_out", 6)
    a, b = (sorted(map(tuple, spark.table(t).collect())) for t in ("plain_out", "late_out"))
    assert a == b


def test_streaming_downsample(spark, tmp_path):
    rows = pings(seed=5)
    run(downsample_stream(stream(spark, tmp_path, rows, 3)), "thin_out")
    got = {r.ping_seq for r in spark.table("thin_out").collect()}
    whole = spark.createDataFrame(rows, PING).withColumn("local_timestamp", F.col("local_timestamp").cast("timestamp_ntz"))
    want = {r.ping_seq for r in prep.downsample(whole).collect()}
    assert got <= want and len(want - got) <= 40  # windows that the watermark has not passed yet
