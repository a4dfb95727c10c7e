"""Decoding of payloads, batch and stream, and the table helpers."""

import pytest
from pyspark.sql import functions as F

from haulwright.functions.timing import elapsed_text, iso_to_utc
from haulwright.operators.timeline import neighbour, running_totals
from haulwright.schemas import TELEMETRY_RAW
from haulwright.sources import tables, telemetry
from haulwright.sources.derived import DerivedInputs


def raw(spark, *payloads):
    rows = [("s", n, 0, "k", p) for n, p in enumerate(payloads)]
    return spark.createDataFrame(rows, TELEMETRY_RAW)


def record(**changes):
    import json

    base = dict(asset_guid="A", site_guid="S", timestamp="2024-01-01T10:30:00Z",
                work_state_id=2, longitude=1.5, latitude=-2.5)
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v != "drop"})


def test_payload_kinds(spark):
    given = raw(spark, "", "null", "{}", " { } ", "[]", "[ ]", "{bad", "12", '"text"', "true",
                record(), f"[{record()}, 7, {{}}, null, {record()}]")
    counts = {r.reason: r.n for r in telemetry.payload_rejects(given).collect()}
    assert counts == {"empty": 1, "null": 1, "empty_object": 2, "empty_array": 2,
                      "broken_json": 1, "scalar": 3, "not_an_object": 3}
    assert telemetry.decode(given).count() == 3


def test_records_that_fail_on_a_field_are_accounted_for(spark):
    given = raw(spark, record(), record(timestamp="yesterday"), f"[{record()}, {record(work_state_id='x', asset_guid='B')}]", "{bad")
    counts = {r.reason: (r.n, r.outcome) for r in telemetry.payload_rejects(given).collect()}
    assert counts == {"broken_json": (1, "error"), "X7": (2, "error")}
    lost = {(r.asset_guid, r.reject, r.timestamp is None) for r in telemetry.rejected(given).collect()}
    assert lost == {("A", "X7", True), ("B", "X7", False)}
    assert telemetry.telemetry(given).count() + 2 == telemetry.decode(given).count()


def test_of_a_repeated_key_the_last_value_counts(spark):
    text = record().replace('"work_state_id": 2', '"work_state_id": 2, "work_state_id": 3')
    assert [r.work_state_id for r in telemetry.typed(raw(spark, text)).collect()] == [3]


def test_sequence_numbers_have_no_bound(spark):
    items = "[" + ", ".join([record()] * 2000) + "]"
    rows = [("s", "9" * 40, 2000, "k", items), ("s", "1" + "0" * 40, 0, "k", record()), ("s", "7" * 40, 1, "k", record())]
    given = spark.createDataFrame(rows, TELEMETRY_RAW)
    best = telemetry.shard_high_water(given).first()
    assert (best.sequence_number, best.sub_sequence_number) == ("1" + "0" * 40, 0)
    seqs = [r.seq for r in telemetry.telemetry(given).orderBy("seq").collect()]
    assert len(set(seqs)) == 2002 and seqs[0].lstrip("0").startswith("7") and seqs[-1].lstrip("0").startswith("10")


def test_bytes_that_are_no_text(spark):
    rows = spark.createDataFrame([("s", 1, 0, "k", b"\xff\xfe{"), ("s", 2, 0, "k", record().encode())],
                                 "shard string, sequence_number bigint, sub_sequence_number bigint, "
                                 "partition_key string, data binary")
    assert [r.reason for r in telemetry.payload_rejects(rows).collect()] == ["broken_json"]
    assert telemetry.telemetry(rows).count() == 1


@pytest.mark.parametrize("change, want", [
    (dict(work_state_id=3.7), 3), (dict(work_state_id="3"), 3), (dict(work_state_id=" 2 "), 2),
    (dict(work_state_id="3.0"), "X7"), (dict(work_state_id=None), "X7"),
    (dict(work_state_id="drop"), "X7"), (dict(asset_guid="drop"), "X7"),
    (dict(site_guid="drop"), "X7"), (dict(site_guid=None), 2), (dict(timestamp="yesterday"), "X7"),
    (dict(longitude="1.25"), 2), (dict(longitude="east"), "X7"), (dict(latitude="1d"), "X7"),
])
def test_typing(spark, change, want):
    row = telemetry.typed(raw(spark, record(**change))).first()
    assert (row.reject or row.work_state_id) == want


def test_times(spark):
    texts = ["2024-01-01T10:30:00Z", "2024-01-01T10:30:00+05:00", "2024-01-01T10:30:00",
             "2024-01-01 10:30:00.250", "2024-01-01", "10:30", "2024-13-01T00:00:00", ""]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    got = [str(r[1]) for r in rows.select("n", iso_to_utc(F.col("t"))).orderBy("n").collect()]
    assert got == ["2024-01-01 10:30:00", "2024-01-01 05:30:00", "2024-01-01 10:30:00",
                   "2024-01-01 10:30:00.250000", "2024-01-01 00:00:00", "None", "None", "None"]


def test_elapsed_text(spark):
    rows = spark.createDataFrame([(3661.12345,), (45.6,), (-1.0,), (360000.0,)], "s double")
    got = [r[0] for r in rows.select(elapsed_text(F.col("s"))).collect()]
    assert got == ["01:01:01.12345", "00:00:45.60000", None, "100:00:00.00000"]


def test_raw_and_direct_telemetry_agree(spark, folder):
    inputs = DerivedInputs(spark, folder)
    direct = inputs.telemetry().where("seq % 50 > 13").drop("seq")
    decoded = telemetry.telemetry(inputs.telemetry_raw().where(
        "(sequence_number * 2 + sub_sequence_number) % 50 > 13")).drop("seq")
    assert decoded.exceptAll(direct).isEmpty() and direct.exceptAll(decoded).isEmpty()


def test_every_event_becomes_telemetry(spark, folder):
    inputs = DerivedInputs(spark, folder)
    want = sorted(r.event_id for r in inputs.table("events").select("event_id").collect())
    assert sorted(r.seq for r in inputs.telemetry().select("seq").collect()) == want
    assert inputs.telemetry_raw().count() == len(want)


def test_decoding_a_stream(spark, tmp_path):
    raw(spark, record(), "[]", f"[{record()}, {record()}]").write.parquet(f"{tmp_path}/in")
    stream = telemetry.telemetry(spark.readStream.schema(TELEMETRY_RAW).parquet(f"{tmp_path}/in"))
    query = (stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c")
             .trigger(availableNow=True).start(f"{tmp_path}/out"))
    query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_reads(spark):
    source = spark.range(100).withColumn("odd", F.col("id") % 2 == 1)
    got = tables.table_read(source, ["id"], "odd", [F.col("id").desc()], 3)
    assert [r.id for r in got.collect()] == [99, 97, 95]
    assert tables.table_read(source, where="id > 1000").count() == 0
    got = tables.sql_read(spark, "SELECT max(id) AS m FROM {t} WHERE id < :top", {"top": 10}, t=source)
    assert got.first().m == 9


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_timeline_equals_one_window(spark, width):
    rows = spark.range(200).selectExpr(
        "id AS seq", "if(id % 3 = 0, 'hot', concat('k', id % 5)) AS k", "id * 37 % 101 AS t", "id % 7 AS v"
    )
    bucket = F.expr(f"t div {width}")
    rows.createOrReplaceTempView("timeline_rows")
    want = spark.sql(
        "SELECT *, sum(v) OVER w AS total, lag(v) OVER w AS b, lead(v) OVER w AS a"
        " FROM timeline_rows WINDOW w AS (PARTITION BY k ORDER BY t, seq)"
    )
    order = ["t", "seq"]
    got = running_totals(rows, ["k"], bucket, order, {"total": F.col("v")})
    got = neighbour(got, ["k"], bucket, order, ["v"], "before")
    got = neighbour(got, ["k"], bucket, order, ["v"], "after", ahead=True)
    got = got.selectExpr("seq", "k", "t", "v", "total", "before.v AS b", "after.v AS a")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_rejects_read_the_payloads_once(spark):
    texts = ["", "null", "{}", "[]", "[ ]", "12", "{", "[7, {}, {\"note\": 1}]", "[[1], null]", "{\"asset_guid\": \"A\"}"]
    raw = spark.createDataFrame(
        [("s", n, 0, t.encode()) for n, t in enumerate(texts)],
        "shard string, sequence_number bigint, sub_sequence_number bigint, data binary",
    )
    found = telemetry.payload_rejects(raw)
    assert {x.reason: x.n for x in found.collect()} == {
        "empty": 1, "null": 1, "empty_object": 1, "empty_array": 2, "scalar": 1, "broken_json": 1, "not_an_object": 4, "X7": 2,
    }
    assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()
