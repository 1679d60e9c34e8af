import json
import os
import random

import pytest
from pyspark.sql import functions as F

from cartlane.schemas import TABLES
from cartlane.sources.sinks import read_batches
from cartlane.streaming import envelope, feed, history, routing, state
from tests.conftest import rows

ORDERS = TABLES["orders"]
COLUMNS = ["order_status_id", "total_amount"]


def record(lsn, key, op, status=None, amount=None, table="orders"):
    after = {} if op == "d" else {"after.id": key, "after.order_status_id": status, "after.total_amount": amount, "after.created_at": 1709251200000 + lsn}
    return json.dumps({"before.id": key if op == "d" else None, **after, "op": op, "source.table": table, "source.lsn": lsn, "source.ts_ms": 1709251200000 + 1000 * lsn, "ts_ms": 0})


# Snapshot of two keys; an update; an insert; a delete; a repeat; one out of order.
FEED = [
    record(1, 1, "r", 1, "10.00"),
    record(2, 2, "r", 1, "20.00"),
    record(3, 1, "u", 2, "10.50"),
    record(4, 3, "c", 1, "30.00"),
    record(5, 2, "d"),
    record(5, 2, "d"),
    record(7, 3, "u", 4, "30.00"),
    record(6, 3, "u", 3, "30.00"),
    record(3, 1, "u", 2, "10.50"),
    record(8, 9, "c", 1, "1.00", table="other"),
]
STATE = [(1, 2, "10.50"), (3, 4, "30.00")]
VISITS = [(1, 1, 1), (1, 2, 3), (2, 1, 2), (3, 1, 4), (3, 3, 6), (3, 4, 7)]


def as_frame(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def decoded(raw, columns=COLUMNS):
    return envelope.decode(raw, ORDERS, columns)


def write_files(path, lines, files):
    path.mkdir()
    for i in range(files):
        part = lines[i * len(lines) // files : (i + 1) * len(lines) // files]
        (path / f"{i:03}.json").write_text("\n".join(part) + "\n")
        os.utime(path / f"{i:03}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    return str(path)


def test_decode_types_times_and_deletes(spark):
    got = envelope.decode(as_frame(spark, FEED), ORDERS)
    assert got.count() == 9
    assert set(ORDERS.schema().names) <= set(got.columns)
    kinds = dict(got.dtypes)
    assert kinds["total_amount"] == "decimal(15,2)" and kinds["created_at"] == "timestamp_ntz" and kinds["id"] == "bigint"
    first = got.filter("lsn = 1").first()
    assert str(first["created_at"]) == "2024-03-01 00:00:00.001000" and str(first["total_amount"]) == "10.00"
    gone = got.filter("op = 'd'").first()
    assert gone["id"] == 2 and gone["deleted"] and gone["total_amount"] is None


def test_decode_does_not_depend_on_the_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert str(envelope.decode(as_frame(spark, FEED[:1]), ORDERS).first()["created_at"]) == "2024-03-01 00:00:00.001000"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_encode_is_the_inverse(spark):
    rows_ = spark.sql("SELECT 5L AS id, 2L AS order_status_id, CAST(7.5 AS DECIMAL(15,2)) AS total_amount, timestamp_ntz'2024-01-02 03:04:05' AS updated_at")
    raw = envelope.encode(rows_, ORDERS, F.lit("u"), F.lit(9), F.lit("2024-01-01").cast("timestamp_ntz"))
    assert json.loads(raw.first()["value"])["after.total_amount"] == "7.50"
    back = envelope.decode(raw, ORDERS, ["order_status_id", "total_amount", "updated_at"]).first()
    assert (back["id"], back["lsn"], str(back["total_amount"]), str(back["updated_at"])) == (5, 9, "7.50", "2024-01-02 03:04:05")


def test_flatten(spark):
    df = spark.sql("SELECT named_struct('id', 1, 'x', named_struct('y', 2)) AS after, 'u' AS op")
    assert envelope.flatten(df).columns == ["after.id", "after.x.y", "op"]
    assert envelope.flatten(df, "_").columns == ["after_id", "after_x_y", "op"]


def shown(df):
    return [(k, s, str(a)) for k, s, a in rows(df, "id", *COLUMNS)]


def test_current_state_of_a_batch(spark):
    assert shown(state.current_state(decoded(as_frame(spark, FEED)))) == STATE
    shuffled = random.Random(1).sample(FEED, len(FEED))
    assert shown(state.current_state(decoded(as_frame(spark, shuffled).repartition(5)))) == STATE


@pytest.mark.parametrize("files", [1, 2, 5])
def test_stream_state_equals_batch_state(spark, tmp_path, files):
    folder = write_files(tmp_path / "in", FEED, files)
    changes = decoded(feed.feed_file_stream(spark, folder, max_files=1))
    state.write_state(changes, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    assert shown(state.read_state(spark, str(tmp_path / "out"))) == STATE


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    folder = write_files(tmp_path / "in", FEED[:4], 2)
    out, log = str(tmp_path / "out"), str(tmp_path / "log")

    def run():
        changes = decoded(feed.feed_file_stream(spark, folder, max_files=1))
        state.write_state(changes, out, log, every=2).awaitTermination()

    run()
    assert shown(state.read_state(spark, out)) == [(1, 2, "10.50"), (2, 1, "20.00"), (3, 1, "30.00")]
    (tmp_path / "in" / "900.json").write_text("\n".join(FEED[2:]) + "\n")
    run()
    run()
    assert shown(state.read_state(spark, out)) == STATE
    (tmp_path / "in" / "901.json").write_text(record(11, 2, "c", 5, "2.00") + "\n" + FEED[0] + "\n")
    run()
    assert shown(state.read_state(spark, out)) == [STATE[0], (2, 5, "2.00"), STATE[1]]


def test_compacted_state_stays_small_and_begins_no_trigger_anew(spark, tmp_path):
    """Also with a new checkpoint, whose triggers begin at 0 again."""
    lines = [record(n, n % 3, "u", n, "1.00") for n in range(1, 25)]
    folder = write_files(tmp_path / "in", lines, 12)
    out = str(tmp_path / "out")
    changes = decoded(feed.feed_file_stream(spark, folder, max_files=1))
    state.write_state(changes, out, str(tmp_path / "log"), every=3).awaitTermination()
    assert [(k, s) for k, s, _ in shown(state.read_state(spark, out))] == [(0, 24), (1, 22), (2, 23)]
    assert len(list((tmp_path / "out" / "changes").glob("batch_id=*"))) <= 2 * 3
    assert len(list((tmp_path / "out" / "compacted").glob("upto=*"))) <= 2
    state.compact_state(spark, out, 11)
    assert len(shown(state.read_state(spark, out))) == 3


def test_history_of_a_batch(spark):
    got = history.status_history(decoded(as_frame(spark, FEED)))
    assert rows(got, "id", "order_status_id", "lsn") == VISITS
    spans = {(r["id"], r["order_status_id"]): (r["since"], r["until"]) for r in got.collect()}
    assert spans[(1, 1)][1] == spans[(1, 2)][0] and spans[(1, 2)][1] is None
    # Order 2 was deleted by the record at 5.
    assert str(spans[(2, 1)][1]) == "2024-03-01 00:00:05"


def test_history_of_deletes_returns_and_null_statuses(spark):
    lines = [record(1, 1, "c", 1), record(2, 1, "d"), record(3, 1, "d"), record(4, 1, "c", 1), record(5, 1, "u", None)]
    lines += [record(6, 1, "u", None), record(7, 1, "u", 1), record(8, 2, "d"), record(9, 2, "c", 3)]
    got = rows(history.status_history(decoded(as_frame(spark, lines))), "id", "lsn", "order_status_id", "until")
    ends = {(k, n): (s, until and until.second) for k, n, s, until in got}
    assert ends == {(1, 1): (1, 2), (1, 4): (1, 5), (1, 5): (None, 7), (1, 7): (1, None), (2, 9): (3, None)}


@pytest.mark.parametrize("max_files", [1, 2, 1000])
@pytest.mark.parametrize("seed", [None, 1, 2])
def test_history_does_not_depend_on_triggers_or_order(spark, tmp_path, max_files, seed):
    lines = list(reversed(FEED)) if seed is None else random.Random(seed).sample(FEED, len(FEED))
    folder = write_files(tmp_path / "in", lines, 5)
    changes = decoded(feed.feed_file_stream(spark, folder, max_files=max_files))
    history.write_status_log(changes, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    assert rows(history.read_history(spark, str(tmp_path / "out")), "id", "order_status_id", "lsn") == VISITS


def test_history_of_nothing(spark, tmp_path):
    assert history.read_history(spark, str(tmp_path / "nothing")).collect() == []


def test_history_when_one_order_has_most_changes(spark):
    rng = random.Random(3)
    lines = [record(n, 1 if rng.random() < 0.6 else rng.randint(2, 30), "u", rng.randint(1, 3), "1.00") for n in range(400)]
    raw = decoded(as_frame(spark, lines + lines[50:90]).repartition(6)).cache()
    want, last = [], {}
    for line in lines:
        r = json.loads(line)
        if last.get(r["after.id"]) != r["after.order_status_id"]:
            last[r["after.id"]] = r["after.order_status_id"]
            want.append((r["after.id"], r["after.order_status_id"], r["source.lsn"]))
    got = history.status_history(raw)
    assert sorted(rows(got, "id", "order_status_id", "lsn")) == sorted(want)
    per_order = {}
    for r in sorted(got.collect(), key=lambda r: r["lsn"]):
        if r["id"] in per_order:
            assert per_order[r["id"]] == r["since"]
        per_order[r["id"]] = r["until"]
    assert set(per_order.values()) == {None}
    visits = history.first_visits(history.status_changes(raw))
    assert len(rows(visits)) == len({(k, s) for k, s, _ in want})


@pytest.mark.parametrize("max_files", [1, 1000])
def test_repeats_go_and_late_records_stay(spark, tmp_path, max_files):
    hours = [record(n, 1, "u", n, "1.00") for n in (1, 5_000, 20_000, 3, 20_000, 1)]
    folder = write_files(tmp_path / "in", hours, 6)
    changes = decoded(feed.feed_file_stream(spark, folder, max_files=max_files))
    state.write_changes(changes, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    once = state.without_repeats(read_batches(spark, str(tmp_path / "out")).drop("batch_id"))
    assert sorted(r["lsn"] for r in once.collect()) == [1, 3, 5_000, 20_000]


def test_records_that_cannot_be_taken_are_counted(spark):
    odd = ["not json", "", '{"op": "u"}', record(30, 1, "z", 1), record(30, 1, "u", 1).replace('"source.lsn": 30', '"source.lsn": null'), record(31, None, "u", 1), '{"after.id": 1']
    raw = as_frame(spark, FEED + odd)
    assert decoded(raw).count() == 9
    got = {r["reason"]: r["records"] for r in envelope.reject_counts(raw, ORDERS).collect()}
    assert got == {"unreadable": 4, "incomplete": 3}
    assert {r["value"] for r in envelope.rejects(raw, ORDERS).collect()} == set(odd)


def test_routing_by_table(spark, tmp_path):
    folder = write_files(tmp_path / "in", FEED + ["not json"], 2)
    out = str(tmp_path / "out")
    routing.route_by_table(feed.feed_file_stream(spark, folder), out, str(tmp_path / "log")).awaitTermination()
    assert routing.routed(spark, out, "orders").count() == 9
    assert routing.routed(spark, out, "other").count() == 1
    assert spark.read.text(out).filter("source_table IS NULL").count() == 1
    assert shown(state.current_state(decoded(routing.routed(spark, out, "orders")))) == STATE


def test_topic_options():
    options = feed.topic_options("broker:9092", "shop")
    assert options["subscribePattern"] == r"shop\.public\..*" and int(options["maxOffsetsPerTrigger"]) > 0
