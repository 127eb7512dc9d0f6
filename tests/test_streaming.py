from datetime import date, timedelta

from tidemark.operators.recurrences import STATE_COLUMNS, with_states
from tidemark.streaming.recurrences import stream_states


def test_stream_matches_history(spark, tmp_path):
    schema = "series_id string, observation_date date, level double"
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(60)]
    rows = [(s, d, None if i == 41 else float(50 + (i * k) % 13)) for s, k in (("a", 7), ("b", 5)) for i, d in enumerate(days)]
    for part in range(3):
        batch = [r for r in rows if days.index(r[1]) // 20 == part]
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = stream_states(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
        query.awaitTermination(120)
    order = lambda df: sorted(tuple(r) for r in df.select("series_id", "observation_date", *STATE_COLUMNS).collect())
    assert str(order(spark.read.parquet(f"{tmp_path}/out"))) == str(order(with_states(spark.createDataFrame(rows, schema))))
