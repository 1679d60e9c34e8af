"""What is kept up to date from the feed, trigger by trigger."""

import json
import random
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlane.modes import REFERENCE, STRICT
from cartlane.operators.audit import orphans
from cartlane.operators.orders import order_totals
from cartlane.schemas import TABLES
from cartlane.sources.sinks import read_batches
from cartlane.streaming import envelope, feed, handover, history, references, repeats, state, totals, versions
from cartlane.testbed.queries import QUERIES
from tests.conftest import rows
from tests.test_changes import FEED, ORDERS, as_frame, decoded, record, write_files

SPAN = ["id", "order_status_id", "since", "lsn", "until"]


def batches(lines, seed, size):
    """The lines in some order, cut into triggers."""
    draw = random.Random(seed)
    mixed = draw.sample(lines, len(lines)) if seed else lines
    return [mixed[i : i + size] for i in range(0, len(mixed), size)]


def long_feed(seed, n=60):
    """Few orders and statuses, so that runs grow, split and close; deletes, nulls and returns."""
    draw = random.Random(seed)
    lines = []
    for lsn in range(n):
        key = draw.choice([1, 1, 1, 2, 3])
        lines.append(record(lsn, key, "d") if draw.random() < 0.15 else record(lsn, key, "u", draw.choice([1, 1, 2, None])))
    return lines


@pytest.mark.parametrize("seed, size", [(1, 24), (0, 48)])
def test_intervals_equal_the_history_of_all_records(spark, tmp_path, seed, size):
    lines = long_feed(seed)
    given = batches(lines + lines[10:20], seed, size)
    for n, part in enumerate(given):
        for _ in range(2 if n == 1 else 1):  # one trigger is run twice
            history.merge_intervals(decoded(as_frame(spark, part)), str(tmp_path), n)
    got = rows(history.read_intervals(spark, str(tmp_path)), *SPAN)
    assert got == rows(history.status_history(decoded(as_frame(spark, lines))), *SPAN)


def test_intervals_after_each_trigger(spark, tmp_path):
    lines = long_feed(9, 24)
    given = batches(lines, 4, 8)
    for n, part in enumerate(given):
        history.merge_intervals(decoded(as_frame(spark, part)), str(tmp_path), n)
        so_far = [line for p in given[: n + 1] for line in p]
        want = history.status_history(decoded(as_frame(spark, so_far)))
        assert rows(history.read_intervals(spark, str(tmp_path)), *SPAN) == rows(want, *SPAN)


def test_intervals_stay_right_when_reduced(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "EVERY", 2)
    monkeypatch.setattr(history, "reduce_before", lambda spark, table, n: versions.reduce_before(spark, table, n, 2))
    lines = long_feed(5, 40)
    for n, part in enumerate(batches(lines, 6, 12)):
        history.merge_intervals(decoded(as_frame(spark, part)), str(tmp_path), n)
    assert list((tmp_path / "runs" / "compacted").glob("upto=*"))
    assert rows(history.read_intervals(spark, str(tmp_path)), *SPAN) == rows(history.status_history(decoded(as_frame(spark, lines))), *SPAN)


def test_a_trigger_reads_only_the_ranges_of_its_keys(spark, tmp_path):
    far = 5 * versions.WIDTH
    first = [record(1, 1, "c", 1), record(2, 1, "u", 2), record(3, far, "c", 1), record(4, far, "u", 3)]
    history.merge_intervals(decoded(as_frame(spark, first)), str(tmp_path), 0)
    kept = str(tmp_path / "kept")
    shutil.copytree(tmp_path / "runs", kept)
    for name in ("runs", "log"):
        for file in (tmp_path / name / "changes" / "batch_id=0" / "bucket=5").glob("*.parquet"):
            file.write_bytes(b"not a table")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    history.merge_intervals(decoded(as_frame(spark, [record(5, 1, "u", 4)])), str(tmp_path), 1)
    table = history._tables(str(tmp_path))[1]
    one = versions.rows_of(spark, table, among=spark.createDataFrame([(1,)], "id long")).filter("alive")
    assert rows(one, "order_status_id", "lsn") == [(1, 1), (2, 2), (4, 5)]
    with pytest.raises(Exception):
        history.read_intervals(spark, str(tmp_path)).collect()


def test_a_reduction_writes_only_ranges_that_changed(spark, tmp_path):
    far, path = 7 * versions.WIDTH, str(tmp_path)
    table = state._table(path)
    add = lambda n, lines: versions.add(table, state.latest_changes(decoded(as_frame(spark, lines))), n)
    add(0, [record(1, 1, "c", 1, "1.00"), record(2, far, "c", 1, "1.00")])
    add(1, [record(3, 1, "u", 2, "1.00")])
    state.compact_state(spark, path, 1)
    add(2, [record(4, 1, "u", 3, "1.00"), record(0, 2, "c", 1, "1.00")])
    state.compact_state(spark, path, 2)
    add(3, [record(2, 1, "u", 9, "1.00"), record(6, 2, "d")])
    folders = lambda upto: {p.name for p in (tmp_path / "compacted" / f"upto={upto}").glob("bucket=*")}
    assert folders(1) == {"bucket=0", "bucket=7"} and folders(2) == {"bucket=0"}
    assert rows(state.read_state(spark, path), "id", "order_status_id") == [(1, 3), (far, 1)]
    for n in range(4, 8):
        add(n, [record(n + 10, 1, "u", n, "1.00")])
        state.compact_state(spark, path, n)
    assert rows(state.read_state(spark, path), "id", "order_status_id") == [(1, 7), (far, 1)]
    # The range that did not change is where it was; of the other the last two reductions stay.
    assert sorted(p.name for p in (tmp_path / "compacted").glob("upto=*")) == ["upto=1", "upto=6", "upto=7"]


# Repeats


def test_intervals_of_positions():
    draw = random.Random(2)
    seen, begins, ends = set(), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for _ in range(200):
        places = np.array(sorted({draw.randrange(60) for _ in range(draw.randrange(6))}), np.int64)
        new = ~repeats.known(begins, ends, places)
        assert new.tolist() == [p not in seen for p in places.tolist()]
        begins, ends = repeats.joined(begins, ends, places[new])
        seen |= set(places.tolist())
        assert {p for a, b in zip(begins, ends) for p in range(a, b + 1)} == seen
        assert all(a > b + 1 for a, b in zip(begins[1:], ends))
    assert len(begins) <= 3


def test_the_log_itself_holds_no_repeat(spark, tmp_path):
    draw = random.Random(1)
    lines = [record(n * 40_000, n % 4, "u", n) for n in range(30)]
    given = draw.sample(lines * 2, 60)
    folder = write_files(tmp_path / "in", given[:40], 2)
    target, log = str(tmp_path / "out"), str(tmp_path / "log")
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def run():
        changes = decoded(feed.feed_file_stream(spark, folder, max_files=1))
        repeats.write_once(changes, target, log).awaitTermination()

    run()
    (tmp_path / "in" / "9.json").write_text("\n".join(given[40:] + lines[:5]) + "\n")
    run()
    got = read_batches(spark, target).drop("batch_id")
    want = state.without_repeats(decoded(as_frame(spark, given)))
    assert rows(got, *want.columns) == rows(want)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_keys_of_a_range_share_a_state(spark, tmp_path):
    """Places at the edges of blocks, keys at the edges of ranges and below zero, one position of many keys."""
    edges = [0, 1, 65_535, 65_536, 131_071]
    lines = [record(lsn, key, "u", 1) for key in (-1025, -1, 0, 1, 1023, 1024) for lsn in edges]
    lines += [record(7, key, "u", 2) for key in range(300)]
    folder = write_files(tmp_path / "in", random.Random(3).sample(lines * 2, len(lines) * 2), 3)
    changes = decoded(feed.feed_file_stream(spark, folder, max_files=1))
    query = repeats.write_once(changes, str(tmp_path / "out"), str(tmp_path / "log"))
    query.awaitTermination()
    got = read_batches(spark, str(tmp_path / "out")).drop("batch_id")
    want = state.without_repeats(decoded(as_frame(spark, lines)))
    assert rows(got, *want.columns) == rows(want) and got.count() == 330
    # Two blocks in each of four ranges, not one state for each of 303 keys and its blocks.
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) == 8


# Totals


def line(lsn, key, op, order=None, quantity=None, price=None, tax=None):
    after = {} if op == "d" else {"after.id": key, "after.order_id": order, "after.quantity": quantity, "after.product_price": price, "after.product_tax": tax}
    return json.dumps({"before.id": key if op == "d" else None, **after, "op": op, "source.table": "orderdetails", "source.lsn": lsn, "source.ts_ms": 0})


@pytest.mark.parametrize("mode", [REFERENCE, STRICT])
def test_totals_after_each_trigger(spark, tmp_path, mode):
    draw = random.Random(3)
    lines = []
    for lsn in range(80):
        gone = draw.random() < 0.2
        lines.append(line(lsn, draw.randrange(12), "d" if gone else "u", draw.randrange(1, 4), draw.randrange(1, 9), f"{draw.randrange(9999) / 100}", f"{draw.randrange(2000) / 100}"))
    seen = []
    for n, part in enumerate(batches(lines + lines[:20], 5, 50)):
        seen += part
        changes = envelope.decode(as_frame(spark, part), TABLES["orderdetails"], totals.LINE)
        for _ in range(2 if n == 1 else 1):
            totals.merge_totals(changes, str(tmp_path), n, mode)
        now = state.current_state(envelope.decode(as_frame(spark, seen), TABLES["orderdetails"], totals.LINE))
        assert rows(totals.read_totals(spark, str(tmp_path))) == rows(order_totals(now, mode=mode))


# References


def of(table, lsn, key, op, **columns):
    after = {} if op == "d" else {"after.id": key, **{f"after.{k}": v for k, v in columns.items()}}
    return json.dumps({"before.id": key if op == "d" else None, **after, "op": op, "source.table": table, "source.lsn": lsn, "source.ts_ms": 0})


def test_orphans_after_each_trigger(spark, tmp_path):
    draw = random.Random(8)
    lines = []
    for lsn in range(90):
        op = "d" if draw.random() < 0.25 else "u"
        if draw.random() < 0.4:
            lines.append(of("users", lsn, draw.randrange(6), op))
        else:
            lines.append(of("orders", lsn, draw.randrange(15), op, user_id=draw.randrange(7), staff_id=draw.choice([None, 0, 1])))
    tables, seen = [TABLES["users"], TABLES["orders"]], []
    for n, part in enumerate(batches(lines, 6, 45)):
        seen += part
        references.merge_references(as_frame(spark, part), tables, str(tmp_path), n)
        users = state.current_state(envelope.decode(as_frame(spark, seen), TABLES["users"], []))
        orders = state.current_state(envelope.decode(as_frame(spark, seen), ORDERS, ["user_id", "staff_id"]))
        got = rows(references.read_orphans(spark, str(tmp_path)), "rule", "key", "rows")
        want = [(f"orders.{c}", *r) for c in ("user_id", "staff_id") for r in rows(orphans(orders, c, users))]
        assert got == sorted(want, key=repr)


# Snapshot and log


def test_snapshot_rows_yield_to_records_of_their_window(spark):
    chunks = spark.createDataFrame([(0, 10, 20), (1, 30, 40)], "chunk int, low long, high long").withColumn("read_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    # Key 1 changes while chunk 0 is read, 2 vanishes, 3 changes after, 4 before, 5 in the window of the other chunk.
    snapshot = [(1, 0, 7), (2, 0, 7), (3, 0, 7), (4, 0, 7), (5, 1, 7), (6, 1, 7)]
    table = spark.createDataFrame(snapshot, "id long, chunk int, order_status_id long")
    lines = [record(15, 1, "u", 2), record(20, 2, "d"), record(21, 3, "u", 3), record(10, 4, "u", 1), record(15, 5, "u", 1)]
    whole = handover.with_snapshot(decoded(as_frame(spark, lines), ["order_status_id"]), table, chunks)
    assert rows(whole.filter("op = 'r'"), "id", "lsn") == [(3, 20), (4, 20), (5, 40), (6, 40)]
    assert rows(state.current_state(whole), "id", "order_status_id") == [(1, 2), (3, 3), (4, 7), (5, 7), (6, 7)]


@pytest.mark.parametrize("seed", range(3))
def test_hand_over_equals_the_whole_log(spark, seed):
    draw = random.Random(seed)
    lines = [record(n, draw.randrange(25), "d" if draw.random() < 0.2 else "u", n % 5, "1.00") for n in range(200)]
    windows = [(c, 40 + 30 * c, 40 + 30 * c + draw.randrange(1, 30)) for c in range(5)]
    table = []
    for c, low, high in windows:
        at, now = draw.randrange(low, high + 1), {}
        for r in map(json.loads, lines[: at + 1]):
            key = r["before.id"] if r["op"] == "d" else r["after.id"]
            now.pop(key, None)
            if r["op"] != "d":
                now[key] = r["after.order_status_id"]
        table += [(k, c, s) for k, s in now.items() if k % 5 == c]
    chunks = spark.createDataFrame(windows, "chunk int, low long, high long").withColumn("read_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    log = decoded(as_frame(spark, lines), ["order_status_id"])
    kept = spark.createDataFrame(table, "id long, chunk int, order_status_id long")
    got = state.current_state(handover.with_snapshot(log.filter("lsn > 40"), kept, chunks))
    assert rows(got, "id", "order_status_id") == rows(state.current_state(log), "id", "order_status_id")


# Values that do not fit


def test_values_that_do_not_fit_are_rejects(spark):
    good = record(40, 1, "u", 1, "1.00")
    bad = [
        good.replace('"1.00"', '"abc"'),
        good.replace('"1.00"', '"12345678901234567.89"'),
        good.replace('"after.order_status_id": 1', '"after.order_status_id": "x"'),
        good.replace('"after.order_status_id": 1', '"after.order_status_id": 1.5'),
        good.replace('"after.order_status_id": 1', '"after.order_status_id": 99999999999999999999'),
        good.replace('"source.ts_ms": 1709251240000', '"source.ts_ms": 9000000000000000000'),
        good.replace('"after.created_at": 1709251200040', '"after.created_at": "soon"'),
    ]
    raw = as_frame(spark, [*FEED, good, *bad])
    assert envelope.decode(raw, ORDERS).count() == 10
    got = {r["reason"]: r["records"] for r in envelope.reject_counts(raw, ORDERS).collect()}
    assert got == {"unfit": 7}
    # A column that nobody asks for is not looked at.
    assert envelope.decode(raw, ORDERS, []).count() == 16
    assert envelope.reject_counts(raw, ORDERS, []).first()["records"] == 1
    assert rows(envelope.rejects(raw, ORDERS), "value") == [(b,) for b in sorted(bad)]


def test_a_record_is_read_from_its_text_once(spark):
    """A filter that passes the reading would read the text again for each field it looks at."""
    raw = as_frame(spark, FEED)
    for df in (decoded(raw), envelope.rejects(raw, ORDERS), envelope.reject_counts(raw, ORDERS)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1


def test_numbers_are_those_of_a_cast(spark):
    """Signs, blanks and other control characters around, digits of another script, and what is no number."""
    given = ["7", "+7", "-7", " 7\n", "\x007\x7f", "\u00a07", "007", "7.", ".7", "1.5", "1e3", "1E-1", "7d", "0x7", "7 7", "--7", "", " ", "-", "x", "\u0667", "\uff17"]
    given += ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "12345678901234567.89", "NaN", "Infinity"]
    texts = spark.createDataFrame([(v,) for v in [*given, None]], "v string")
    for to in (ORDERS.column("id").spark_type(), ORDERS.column("total_amount").spark_type()):
        got = texts.select("v", envelope._fitting(F.col("v"), to).alias("n"))
        assert rows(got) == rows(texts.select("v", F.col("v").try_cast(to).alias("n")))


def test_a_record_cut_off_anywhere_is_unreadable(spark):
    whole = record(40, 1, "u", 1, "1.00")
    cut = [whole[:n] for n in range(len(whole))]
    assert rows(envelope.reject_counts(as_frame(spark, cut), ORDERS)) == [("unreadable", len(cut))]
    assert envelope.decode(as_frame(spark, [whole, whole + " more"]), ORDERS).count() == 2


def small_events(spark, folder, n=400):
    """Events of the supplied shape: few users, all types, one or two of them null."""
    kinds = F.element_at(F.array(*[F.lit(k) for k in ("signup", "view", "click", "purchase", "error")]), (F.xxhash64("id") % 5 + 5).cast("int") % 5 + 1)
    events = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.timestamp_add("SECOND", F.col("id") * 60, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"),
        (F.col("id") * 7 % 31).alias("user_id"),
        kinds.alias("event_type"),
        (F.col("id") % 90 + 0.25).alias("value"),
    )
    events.write.parquet(f"{folder}/events.parquet")
    return spark.read.parquet(f"{folder}/events.parquet")


def test_the_spoiled_feed_is_made_in_one_pass(spark, tmp_path):
    events = small_events(spark, tmp_path)
    got = QUERIES["cdc_rejects"](spark, str(tmp_path))
    # Once for what can be taken and once for what cannot, not once for each kind.
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    updates = events.filter("event_type not in ('signup', 'error')").count()
    assert rows(got) == [("incomplete", updates), ("none", 400), ("unfit", 4 * updates), ("unreadable", 400)]


def test_the_hand_over_decodes_its_feed_once(spark, tmp_path):
    events = small_events(spark, tmp_path)
    got = QUERIES["cdc_snapshot_and_log"](spark, str(tmp_path))
    # The log is read several times, from where its decoded records lie.
    assert "from_json(" not in got._jdf.queryExecution().optimizedPlan().toString()
    last = events.groupBy("user_id").agg(F.max_by(F.struct("event_type", "value"), "event_id").alias("last")).filter("last.event_type != 'error'")
    want = {(r["user_id"], f"{r['last']['value']:.2f}") for r in last.collect()}
    assert {(r["id"], str(r["total_amount"])) for r in got.collect()} == want and got.count() == len(want)


def test_a_stream_goes_on_after_bad_values(spark, tmp_path):
    bad = record(9, 1, "u", 1, "ten")
    folder = write_files(tmp_path / "in", [*FEED, bad], 2)
    changes = decoded(feed.feed_file_stream(spark, folder, max_files=1))
    history.write_status_log(changes, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    want = history.status_history(decoded(as_frame(spark, FEED)))
    assert rows(history.read_history(spark, str(tmp_path / "out")), *SPAN) == rows(want, *SPAN)
