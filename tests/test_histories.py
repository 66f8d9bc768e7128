"""Running values, density, sessions and medians against brute force, across slot borders."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from riskrules.operators import ordered, sequences, sessions
from riskrules.operators.ordered import Running

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def history():
    """One account holds most rows; equal times occur."""
    rng = random.Random(1)
    rows = []
    for i in range(600):
        account = 1 if rng.random() < 0.7 else rng.randint(2, 5)
        rows.append((i, account, T0 + dt.timedelta(minutes=rng.randint(0, 4000)), round(rng.uniform(0, 50), 2), rng.choice("ab")))
    return rows


SCHEMA = "event_id long, account_id long, event_time timestamp, value double, kind string"


def by_account(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault(r[1], []).append(r)
    return groups


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("with_current", [False, True])
def test_running_over_slots(spark, history, forward, with_current):
    df = spark.createDataFrame(history, SCHEMA)
    kinds = {k: Running(k, F.col("value"), forward, with_current) for k in ("sum", "count", "min", "max")}
    found = ordered.running(df, ["account_id"], ["event_time", "event_id"], kinds, slot=F.floor(F.unix_seconds("event_time") / 3600))
    got = {r["event_id"]: r for r in found.collect()}
    for rows in by_account(history).values():
        for i, r in enumerate(rows):
            if forward:
                part = rows[i if with_current else i + 1 :]
            else:
                part = rows[: i + 1 if with_current else i]
            values = [p[3] for p in part]
            g = got[r[0]]
            assert g["count"] == len(values)
            assert (g["sum"] or 0) == pytest.approx(sum(values))
            assert (g["min"], g["max"]) == ((min(values), max(values)) if values else (None, None))


def test_next_after(spark, history):
    df = spark.createDataFrame(history, SCHEMA)
    found = ordered.next_after(df, ["account_id"], {"next_b": (F.col("kind") == "b", F.struct("event_id", "value"))})
    got = {r["event_id"]: r["next_b"] for r in found.collect()}
    for rows in by_account(history).values():
        for i, r in enumerate(rows):
            later = next((p for p in rows[i + 1 :] if p[4] == "b"), None)
            assert (got[r[0]] and got[r[0]]["event_id"]) == (later and later[0])


def test_first_per_key(spark, history):
    df = spark.createDataFrame(history, SCHEMA)
    got = sorted((r["account_id"], r["position"], r["event_id"]) for r in ordered.first_per_key(df, ["account_id"], ["event_time", "event_id"], 3, salts=4).collect())
    assert got == sorted((a, i + 1, r[0]) for a, rows in by_account(history).items() for i, r in enumerate(rows[:3]))


def test_density_windows(spark, history):
    pays = [(r[0], r[1], r[2]) for r in history] + [(9000 + i, 9, T0 + dt.timedelta(minutes=m)) for i, m in enumerate((0, 1, 2, 6, 36, 1440, 1440))]
    df = spark.createDataFrame(pays, "pay_id long, account_id long, event_time timestamp")
    widths = (2, 30, 60, 100_000)
    found = sequences.payment_density(df, widths)
    for r in found.collect():
        times = [p[2] for p in pays if p[1] == r["account_id"]]
        for w in widths:
            assert r[f"max_num_payments_{w}_minutes"] == max(sum(t <= u <= t + dt.timedelta(minutes=w) for u in times) for t in times)


def test_grouped_median(spark, history):
    df = spark.createDataFrame(history + [(7001, 8, T0, -3.0, "a"), (7002, 8, T0, 0.0, "a"), (7003, 8, T0, None, "a")], SCHEMA)
    got = {r["account_id"]: r["median"] for r in ordered.grouped_median(df, "account_id", "value").collect()}
    for a, rows in by_account(history).items():
        assert got[a] == pytest.approx(statistics.median(r[3] for r in rows))
    assert got[8] == -1.5


@pytest.mark.parametrize("tiles", [1, 7, 20])
def test_global_ntile(spark, tiles):
    rng = random.Random(3)
    rows = [(i, 5 if rng.random() < 0.5 else rng.randint(0, 300)) for i in range(997)]
    df = spark.createDataFrame(rows, "id long, v int")
    got = {r["id"]: r["tile"] for r in ordered.global_ntile(df, "v", "id", tiles, parts=16).collect()}
    want, start = {}, 0
    line = sorted(rows, key=lambda r: (r[1], r[0]))
    for t in range(tiles):
        size = len(line) // tiles + (t < len(line) % tiles)
        for r in line[start : start + size]:
            want[r[0]] = t + 1
        start += size
    assert got == want


def session_by_hand(rounds):
    """The streak measures straight from their definition."""
    out, last_loss, size, value = {}, None, 0, 0.0
    for i, (spin, t, bet, win) in enumerate(rounds):
        if not win - bet > 0:
            last_loss = t
        if last_loss is not None and t > last_loss:
            size, value = size + 1, value + win - bet
        rest = sum(w - b for _, _, b, w in rounds[i + 1 :]) if i + 1 < len(rounds) else None
        out[spin] = (last_loss, size, value, rest)
    return out


def test_session_losses_over_slots(spark):
    rng = random.Random(5)
    sizes = {(1, 1): 200, (1, 2): 5, (2, 1): 60}
    rows, spin = [], 0
    want = {}
    for (account, session), n in sizes.items():
        rounds = []
        for _ in range(n):
            spin += 1
            rounds.append((spin, T0 + dt.timedelta(hours=rng.uniform(0, 24 * 9)), round(rng.uniform(0, 9), 2), round(rng.choice([0, 0, 20]) * rng.random(), 2)))
        rounds.sort(key=lambda r: (r[1], r[0]))
        want.update(session_by_hand(rounds))
        rows += [(s, account, t, b, w, session) for s, t, b, w in rounds]
    df = spark.createDataFrame(rows, "spin_id long, account_id long, event_time timestamp, bet_money double, win_amount double, session_id long")
    for r in sessions.session_losses(df).collect():
        last_loss, size, value, rest = want[r["spin_id"]]
        assert (r["last_loss"], r["win_streak_size"]) == (last_loss, size)
        assert r["win_streak_value"] == pytest.approx(value)
        assert (r["subsequent_profit"] is None) == (rest is None)
        if rest is not None:
            assert r["subsequent_profit"] == pytest.approx(rest, abs=1e-6)


def test_streaks_never_reset_but_runs_do(spark):
    nets = [5, 5, -1, 4, 6]
    rows = [(i, 1, T0 + dt.timedelta(days=i), 10.0, 10.0 + n, 1) for i, n in enumerate(nets)]
    df = spark.createDataFrame(rows, "spin_id long, account_id long, event_time timestamp, bet_money double, win_amount double, session_id long")
    streak = [r["win_streak_size"] for r in sessions.session_losses(df).orderBy("spin_id").collect()]
    runs = [r["win_run"] for r in sessions.win_runs(df).orderBy("spin_id").collect()]
    assert streak == [0, 0, 0, 1, 2]
    assert runs == [1, 2, 0, 1, 2]


def test_first_amounts_and_statistics(spark):
    rows = [(1, 1, T0, 5.0), (2, 1, T0 + dt.timedelta(seconds=90), 7.0), (3, 2, T0, 1.0)]
    df = spark.createDataFrame(rows, "pay_id long, account_id long, event_time timestamp, pay_amount double")
    first = {r["account_id"]: r for r in sequences.first_amounts(df).collect()}
    assert (first[1]["first_payment"], first[1]["second_payment"], first[1]["third_payment"], first[1]["minutes_first_to_second"]) == (5.0, 7.0, None, 1.5)
    assert first[2]["second_payment"] is None
    stats = {r["account_id"]: r for r in sequences.amount_stats(df).collect()}
    assert (stats[1]["median_payment"], stats[1]["rel_payment_range"], stats[2]["number_payments"]) == (6.0, pytest.approx(0.4), 1)
