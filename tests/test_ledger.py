"""Queue and sender scenarios of the reference's tests, re-aimed as ledger queries."""


from devmetrics.operators import depth, ledger, sender

S = 10**9

from pyspark.sql import functions as F  # noqa: E402


def _ledger(spark, enq, disp, acks):
    e = spark.createDataFrame(enq, "persist_key long, enqueued_ns long, outcome string")
    d = spark.createDataFrame(disp, "message_id string, persist_key long, sent_ns long")
    a = spark.createDataFrame(acks, "message_id string, ack_ns long")
    return e, d, a


def test_ack_known_unknown_empty(spark):
    e, d, a = _ledger(spark, [(1, 0, "enqueued")], [("m1", 1, 0)],
                      [("m1", 1 * S), ("m1", 2 * S), ("ghost", 1 * S), ("", 1 * S)])
    m = ledger.match_acks(d, a, 30 * S).collect()
    assert [(r.message_id, r.ack_ns, r.on_time) for r in m] == [("m1", 1 * S, True)]  # second ack has no effect
    assert [r.message_id for r in ledger.unknown_acks(d, a).collect()] == ["ghost"]
    assert ledger.invalid_acks(a).count() == 1
    assert ledger.unacked(e, d, a, 30 * S, 10 * S).count() == 0


def _mixed(spark):
    """Sent at 0, 30 s timeout, scans every 10 s: the requeue tick is 40 s."""
    enq = [(k, 0, "enqueued") for k in range(1, 7)] + [(9, 0, "rejected")]
    disp = [(f"m{k}", k, 0) for k in range(1, 6)] + [("n3", 3, 50 * S)]
    acks = [("m1", 5 * S), ("m1", 60 * S), ("m1", 5 * S),  # in time, then twice more
            ("m2", 40 * S), ("m2", 70 * S),  # at the tick: too late
            ("m3", 45 * S), ("n3", 55 * S),  # first delivery late, second in time
            ("m4", 39 * S), ("ghost", 1 * S), ("", 1 * S), (None, 2 * S)]
    return _ledger(spark, enq, disp, acks)


def test_only_acks_in_time_delete_the_durable_copy(spark):
    e, d, a = _mixed(spark)
    done = ledger.effective_acks(d, a, 30 * S, 10 * S).collect()
    assert sorted((r.message_id, r.ack_ns) for r in done) == [("m1", 5 * S), ("m4", 39 * S), ("n3", 55 * S)]
    assert sorted(r.persist_key for r in ledger.unacked(e, d, a, 30 * S, 10 * S).collect()) == [2, 5, 6]
    classes = {r.ack_class: r.acks for r in ledger.ack_classes(d, a, 30 * S, 10 * S).collect()}
    assert classes == {"effective": 3, "repeated": 2, "late": 3, "unknown": 1, "invalid": 2}
    assert sum(classes.values()) == a.count()
    late = sorted((r.message_id, r.ack_ns) for r in ledger.late_acks(d, a, 30 * S, 10 * S).collect())
    assert late == [("m2", 40 * S), ("m2", 70 * S), ("m3", 45 * S)]
    assert [r.persist_key for r in ledger.dead_letters(d, a, 1, 30 * S, 10 * S).orderBy("persist_key").collect()] == [2, 5]


def test_counters_and_ready_list_at_an_instant(spark):
    e, d, a = _mixed(spark)
    c = {r.counter: r.value for r in ledger.queue_counters(e, d, a, 45 * S, 30 * S, 10 * S).collect()}
    # by 45 s: five deliveries, m1 and m4 acked, three requeued at 40 s, none pending; key 6 was never sent
    assert c == {"enqueued": 6, "rejected": 1, "invalid": 0, "closed": 0, "persist_failed": 0, "dispatched": 5, "acked": 2,
                 "requeued": 3, "pending": 0, "unknown_acks": 1, "invalid_acks": 2, "recovered": 4, "queue": 4}
    ready = {r.persist_key: (r.source, r.ready_ns) for r in ledger.ready_after_requeue(e, d, a, 45 * S, 30 * S, 10 * S).collect()}
    assert ready == {2: ("requeue", 40 * S), 3: ("requeue", 40 * S), 5: ("requeue", 40 * S), 6: ("backlog", 0)}
    # at 52 s the second delivery of key 3 is pending; at 20 s all five are
    assert {r.persist_key for r in ledger.ready_after_requeue(e, d, a, 52 * S, 30 * S, 10 * S).collect()} == {2, 5, 6}
    early = {r.counter: r.value for r in ledger.queue_counters(e, d, a, 20 * S, 30 * S, 10 * S).collect()}
    assert (early["pending"], early["requeued"], early["queue"]) == (4, 0, 1)


def test_depth_with_requeues(spark):
    e, d, a = _mixed(spark)
    got = depth.queue_depth(depth.depth_events(e, d, ledger.requeues(d, a, 30 * S, 10 * S))).orderBy("event_ns", "delta", "persist_key").collect()
    assert [r.depth for r in got if r.kind == "requeue"] == [2, 3, 4] and got[-1].depth == 3


def test_timeout_is_strict(spark):
    # sent 1 s ago with a 50 ms timeout -> expired; sent now with 30 s -> still pending; exactly the timeout -> kept.
    as_of = 100 * S
    _, d, a = _ledger(spark, [], [("old", 1, as_of - 60 * S), ("new", 2, as_of), ("edge", 3, as_of - 30 * S)], [])
    short = {r.message_id for r in ledger.expired_pending(d, a, as_of, 50_000_000).collect()}
    assert short == {"old", "edge"}
    long_ = {r.message_id for r in ledger.expired_pending(d, a, as_of, 30 * S).collect()}
    assert long_ == {"old"}  # 'edge' waited exactly 30 s: not more than the timeout


def test_recovery_counts(spark):
    enq = [(k, k * S, "enqueued") for k in range(1, 4)]
    disp = [(f"m{k}", k, k * S) for k in range(1, 4)]
    e, d, a = _ledger(spark, enq, disp, [("m2", 5 * S)])
    assert sorted(r.persist_key for r in ledger.unacked(e, d, a, 30 * S, 10 * S).collect()) == [1, 3]
    order = depth.fifo_order(ledger.unacked(e, d, a, 30 * S, 10 * S).select("persist_key"), bucket_keys=2).orderBy("persist_key")
    assert [(r.persist_key, r.position) for r in order.collect()] == [(1, 1), (3, 2)]


def test_requeue_keeps_key_new_id(spark):
    e, d, a = _ledger(spark, [(7, 0, "enqueued")], [("m1", 7, 0), ("m2", 7, 40 * S)], [("m2", 41 * S)])
    r = ledger.requeue_times(d, a, 30 * S, 10 * S).orderBy("message_id").collect()
    assert r[0].requeued and r[0].requeue_tick_ns == 40 * S  # first tick with tick - sent > 30 s
    assert not r[1].requeued
    assert ledger.deliveries(d).first().deliveries == 2
    assert ledger.unacked(e, d, a, 30 * S, 10 * S).count() == 0


def test_lost_acks_audit(spark):
    n = 1000
    enq = [(k, k, "enqueued") for k in range(n)]
    disp = [(f"a{k}", k, k) for k in range(n)] + [(f"b{k}", k, k + 40 * S) for k in range(0, n, 10)]
    acks = [(f"a{k}", k + S) for k in range(n) if k % 10] + [(f"b{k}", k + 41 * S) for k in range(0, n, 10)]
    e, d, a = _ledger(spark, enq, disp, acks)
    audit = {r.check: r.value for r in ledger.at_least_once_audit(e, d, a, 30 * S, 10 * S).collect()}
    assert audit["accepted"] == n and audit["unique_acked"] == n and audit["missing"] == 0
    assert audit["dispatches"] > n


def test_saturation_accounting(spark):
    enq = [(k, k, "enqueued" if k < 50 else "rejected") for k in range(2000)]
    e, _, _ = _ledger(spark, enq, [], [])
    r = ledger.reject_rate(e).first()
    assert r.attempts == 2000 and r.rejected == 1950 and r.reject_rate_pct == 97.5


def test_queue_depth_never_negative_and_matches_brute_force(spark):
    import random

    rnd = random.Random(7)
    enq, disp = [], []
    for k in range(500):
        t = rnd.randrange(0, 3600) * S
        enq.append((k, t, "enqueued"))
        disp.append((f"m{k}", k, t + rnd.randrange(0, 600) * S))
    e, d, _ = _ledger(spark, enq, disp, [])
    got = depth.queue_depth(depth.depth_events(e, d), bucket_ns=60 * S).collect()
    events = sorted([(t, 1, k, "accept") for k, t, _ in enq] + [(t, -1, k, "dispatch") for _, k, t in disp])
    running, expected = 0, {}
    for t, delta, k, kind in events:
        running += delta
        expected[(k, kind)] = running
    assert {(r.persist_key, r.kind): r.depth for r in got} == expected
    assert min(expected.values()) >= 0


def test_high_water_integer_division(spark):
    df = spark.createDataFrame([(1, 0, 1, "accept", 2)], "persist_key long, event_ns long, delta int, kind string, depth long")
    hw = depth.high_water(df, 3, 80).first()  # 2*100 div 3 = 66 -> below 80
    assert hw.fill_pct == 66 and not hw.high_water


def test_sender_outcomes(spark):
    rows = []
    for key, codes in {1: ["ResourceExhausted", "OK"], 2: ["ResourceExhausted"] * 3, 3: ["InvalidArgument", "OK"],
                       4: ["LogicalFailure", "OK"], 5: ["OK"]}.items():
        rows += [(key, i, c) for i, c in enumerate(codes)]
    a = spark.createDataFrame(rows, "message_key long, attempt long, code string")
    got = {r.message_key: (r.outcome, r.attempts_used) for r in sender.sender_rollup(a, max_retries=2).collect()}
    assert got == {1: ("sent", 2), 2: ("dropped", 3), 3: ("dropped", 1), 4: ("sent", 2), 5: ("sent", 1)}
    totals = {r.outcome: r.messages for r in sender.sender_totals(sender.sender_rollup(a, 2)).collect()}
    assert totals == {"sent": 3, "dropped": 2}


def test_sink_rollup(spark):
    log = spark.createDataFrame([("a", True, True), ("b", True, False), ("c", False, False)],
                                "message_id string, write_ok boolean, ack_ok boolean")
    r = ledger.sink_rollup(log).first()
    assert (r.processed, r.write_failed, r.ack_failed) == (2, 1, 1)


def test_exact_percentiles_hot_group(spark):
    import math
    import random

    rnd = random.Random(5)
    rows = [("hot" if i % 4 else rnd.choice(["a", "b"]), rnd.randrange(0, 100_000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v long")
    qs = {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p0": 0.0}
    out = ledger.exact_percentiles(df, "g", "v", qs, F.call_function("div", F.col("v"), F.lit(1000)))
    got = {r.g: (r.acked, r.p50, r.p95, r.p99, r.p0) for r in out.collect()}
    for g in {"hot", "a", "b"}:
        vals = sorted(v for k, v in rows if k == g)
        n = len(vals)
        pick = [vals[max(1, math.ceil(n * q)) - 1] for q in qs.values()]
        assert got[g] == (n, *pick)


def _brute(disp, acks, timeout, scan):
    """The queue's own rule, event by event: sendings put an id into the pending map, a scan tick takes overdue ones out,
    an ack completes a pending id."""
    pending, done, classes, first = {}, {}, [], {}
    keys = {m: k for m, k, _ in disp}
    events = sorted([(t, 1, m, None) for m, _, t in disp] + [(t, 2, m or "", i) for i, (m, t) in enumerate(acks)])
    ticks = sorted({((t + timeout) // scan + 1) * scan for _, _, t in disp})
    events = sorted([*events, *[(t, 0, "", None) for t in ticks]], key=lambda e: e[:3])
    sent, late = {}, []
    for t, what, m, i in events:
        if what == 0:
            for x in [x for x, s in pending.items() if t - s > timeout]:
                del pending[x]
        elif what == 1:
            pending[m] = sent[m] = t
        elif not m:
            classes.append("invalid")
        elif m not in sent:
            classes.append("unknown")
        else:
            first.setdefault(m, t)
            if m in pending:
                del pending[m]
                done[m] = t
                classes.append("effective")
            elif m in done:
                classes.append("repeated")
            else:
                classes.append("late")
                late.append((m, t))
    return done, classes, first, late, {keys[m] for m in done}


def test_acks_before_on_in_and_after_the_window(spark):
    """Any mix of acks around sending (100 s), timeout and tick (140 s), for every delivery, against the queue's rule."""
    import itertools
    from collections import Counter

    at = [50, 99, 100, 101, 130, 131, 139, 140, 141, 200]
    mixes = [c for n in (0, 1, 2, 3) for c in itertools.combinations_with_replacement(at, n)]
    disp, acks, enq = [], [("", 5 * S), (None, 7 * S), ("ghost", 100 * S), ("ghost", 1 * S)], [(10**6, 0, "enqueued")]
    for k, mix in enumerate(mixes):
        disp.append((f"m{k}", k, 100 * S))
        enq.append((k, 90 * S, "enqueued"))
        acks += [(f"m{k}", t * S) for t in mix]
    e, d, a = _ledger(spark, enq, disp, acks)
    scan = (30 * S, 10 * S)
    done, classes, first, late, keys = _brute(disp, acks, *scan)
    assert {r.message_id: r.ack_ns for r in ledger.effective_acks(d, a, *scan).collect()} == done
    got = {r.ack_class: r.acks for r in ledger.ack_classes(d, a, *scan).collect()}
    assert got == {c: Counter(classes)[c] for c in ("effective", "repeated", "late", "unknown", "invalid")}
    assert sorted((r.message_id, r.ack_ns) for r in ledger.late_acks(d, a, *scan).collect()) == sorted(late)
    assert ledger.unknown_acks(d, a).count() == got["unknown"]
    times = {r.message_id: r for r in ledger.requeue_times(d, a, *scan).collect()}
    assert {m for m, r in times.items() if r.acked_in_time} == set(done) and len(times) == len(disp)
    assert all(r.requeued != r.acked_in_time and r.first_ack_ns == first.get(m) for m, r in times.items())
    matched = {r.message_id: (r.ack_ns, r.latency_ns, r.on_time) for r in ledger.match_acks(d, a, 30 * S).collect()}
    assert matched == {m: (t, t - 100 * S, t - 100 * S <= 30 * S) for m, t in first.items()}
    accepted = {k for k, _, _ in enq}
    assert {r.persist_key for r in ledger.unacked(e, d, a, *scan).collect()} == accepted - keys
    assert {r.persist_key for r in ledger.dead_letters(d, a, 1, *scan).collect()} == {k for _, k, _ in disp} - keys
    waiting = {r.message_id for r in ledger.expired_pending(d, a, 300 * S, 30 * S).collect()}
    assert waiting == {m for m, _, _ in disp} - set(first)
    audit = {r.check: r.value for r in ledger.at_least_once_audit(e, d, a, *scan).collect()}
    assert audit["effective_acked"] == len(keys) and audit["missing"] == len(accepted - keys)
    ready = {r.persist_key for r in ledger.ready_after_requeue(e, d, a, 300 * S, *scan).collect()}
    assert ready == accepted - keys
    for as_of in (60, 100, 120, 139, 140, 150, 300):
        by = [x for x in acks if x[1] <= as_of * S], [x for x in disp if x[2] <= as_of * S]
        c = {r.counter: r.value for r in ledger.queue_counters(e, d, a, as_of * S, *scan).collect()}
        done_by, classes_by, *_ = _brute(by[1], by[0], *scan)
        n = Counter(classes_by)
        assert (c["acked"], c["unknown_acks"], c["invalid_acks"]) == (len(done_by), n["unknown"], n["invalid"])
        assert c["requeued"] + c["pending"] == len(by[1]) - len(done_by) and (c["pending"] == 0 or as_of < 140)
