"""Carried stream state: out-of-order files, replays, and what a batch reads."""

import random

import pytest

from devmetrics.streaming import carried, streams

S = 10**9
TIMEOUT = 30 * S


def _ledger(seed, n=300):
    rnd = random.Random(seed)
    sent = {f"m{i}": rnd.randrange(0, 3600) * S for i in range(n)}
    rows = [("delivery", m, i, t) for i, (m, t) in enumerate(sent.items())]
    for m, t in sent.items():
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            rows.append(("ack", m, None, t + rnd.choice([-50, -1, 0, 5, 29, 30, 31, 400]) * S))
    rows += [("ack", "ghost", None, 5 * S), ("ack", "", None, 6 * S), ("ack", None, None, 7 * S)]
    timely = {m for side, m, _, t in rows if side == "ack" and m in sent and sent[m] <= t <= sent[m] + TIMEOUT}
    rnd.shuffle(rows)
    return rows, sent, set(sent) - timely


def _states(path):
    import os

    return sorted(os.listdir(f"{path}/state"))


@pytest.mark.parametrize("seed", [1, 2])
def test_open_deliveries_over_files_out_of_order(spark, tmp_dir, seed):
    rows, sent, want = _ledger(seed)
    write = carried.open_deliveries_writer(f"{tmp_dir}/open", TIMEOUT)
    for n in range(8):
        batch = spark.createDataFrame(rows[n::8], carried.LEDGER)
        write(batch, n)
        if n in (3, 7):  # replayed, with the state it wrote already there
            write(batch, n)
        assert [s for s in _states(f"{tmp_dir}/open") if s.startswith("v=")] == [f"v={v}" for v in (n - 1, n) if v >= 0]
    got = carried.open_deliveries(spark, f"{tmp_dir}/open", TIMEOUT).collect()
    assert sorted((r.message_id, r.sent_ns) for r in got) == sorted((m, sent[m]) for m in want) and {r.reason for r in got} == {"timeout"}
    early = carried.open_deliveries(spark, f"{tmp_dir}/open", TIMEOUT, as_of_ns=1000 * S).collect()
    assert {r.message_id for r in early} == {m for m in want if 1000 * S - sent[m] > TIMEOUT}


def test_state_is_bounded_by_the_delay(spark, tmp_dir):
    """In order to within the delay: what can't change any more leaves the state, and nothing is lost."""
    rows, sent, want = _ledger(3, 400)
    rows = sorted((r for r in rows if r[1] in sent), key=lambda r: r[3] // (60 * S))
    write = carried.open_deliveries_writer(f"{tmp_dir}/open", TIMEOUT, max_delay_ns=500 * S)
    sizes = []
    for n in range(12):
        part = rows[n * len(rows) // 12:(n + 1) * len(rows) // 12]
        write(spark.createDataFrame(part, carried.LEDGER), n)
        sizes.append(spark.read.schema(carried.LEDGER).parquet(f"{tmp_dir}/open/state/v={n}").count())
    assert max(sizes) < len(rows) / 3
    got = [r.message_id for r in carried.open_deliveries(spark, f"{tmp_dir}/open", TIMEOUT).collect()]
    assert sorted(got) == sorted(want)


def test_nothing_written_yet(spark, tmp_dir):
    assert carried.open_deliveries(spark, f"{tmp_dir}/none", TIMEOUT).collect() == []


SCHEMA = "series_id string, timestamp_ns long, metric_name string, persist_key long, value double"
DAY = 86_400 * S


def test_first_copies_over_files_out_of_order(spark, tmp_dir):
    rnd = random.Random(4)
    keys = [(rnd.choice(["a", "b", None]), rnd.randrange(5 * 24) * 3600 * S, rnd.choice(["t", "u"])) for _ in range(150)]
    rows = [(*k, i, float(i)) for i, k in enumerate(keys * 3)]
    rnd.shuffle(rows)
    write = carried.first_copies_writer(f"{tmp_dir}/keys", streams.batch_dir_writer(f"{tmp_dir}/out"))
    seen, want = set(), []
    for n in range(8):
        part = rows[n::8]
        for key in sorted({r[:3] for r in part} - seen, key=str):
            want.append(min((r for r in part if r[:3] == key), key=lambda r: r[3]))
            seen.add(key)
        for _ in range(2 if n in (2, 7) else 1):  # some batches are replayed
            write(spark.createDataFrame(part, SCHEMA), n)
    got = [tuple(r)[:5] for r in spark.read.parquet(f"{tmp_dir}/out").select("series_id", "timestamp_ns", "metric_name", "persist_key", "value").collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == len(set(keys))


def test_a_batch_reads_touched_days_only(spark, tmp_dir, monkeypatch):
    read, real = [], carried.touched_segments
    monkeypatch.setattr(carried, "touched_segments", lambda *a: read.append(real(*a)) or read[-1])
    write = carried.first_copies_writer(f"{tmp_dir}/keys", streams.batch_dir_writer(f"{tmp_dir}/out"))
    rows = lambda *days: spark.createDataFrame([("s", d * DAY + i, "m", i, 0.0) for d in days for i in range(50)], SCHEMA)
    write(rows(*range(10)), 0)
    write(rows(3), 1)
    write(rows(7, 20), 2)
    assert read[0] == [] and {f.split("date=")[1][:10] for f in read[1]} == {"1970-01-04"} and {f.split("date=")[1][:10] for f in read[2]} == {"1970-01-08"}
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 11 * 50
