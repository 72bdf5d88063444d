import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import closed_form, fold, stage

D = [date(2024, 1, 1) + timedelta(days=i) for i in range(40)]
LOOSE = fold.Limits(least_rows=1, missing_per_day=1.0, missing_most=1.0)


def snap(spark, rows):
    return spark.createDataFrame([(str(i), v) for i, v in rows], "ID string, NZ string")


def run(spark, series, limits=LOOSE):
    """Folds (day, source, rows); returns state by key, events and verdicts."""
    state, previous, events, verdicts = fold.empty_state(spark), None, [], []
    for day, source, rows in series:
        staged = stage.stage(snap(spark, rows))
        pairs = fold.matched(state, staged.snapshot)
        verdict = fold.judge(pairs, staged.stats["rows_raw"], day, source, previous, limits)
        events += [(r["record_key"], r["event"], r["snapshot_date"]) for r in fold.history(pairs, day, source, verdict.suspect).collect()]
        state = spark.createDataFrame(fold.next_state(pairs, day, source, previous, verdict.suspect).collect(), fold.STATE)
        previous = fold.Previous(day, source)
        verdicts.append(verdict)
    return {r["record_key"]: r.asDict() for r in state.collect()}, events, verdicts


def test_appear_change_close_return(spark):
    state, events, _ = run(spark, [(D[0], "a", [(1, "x"), (2, "y"), (3, "z")]), (D[1], "a", [(1, "x2"), (3, "z")]), (D[3], "a", [(1, "x2"), (2, "y"), (3, "z")])])
    assert state["1"]["revision_no"] == 2 and state["1"]["first_seen"] == D[0] and state["1"]["is_present"]
    two = state["2"]
    assert two["is_present"] and two["returned_at"] == D[3] and two["disappeared_at"] is None and two["disappeared_count"] == 1 and two["revision_no"] == 1
    assert state["3"]["returned_at"] is None and state["3"]["revision_no"] == 1
    assert sorted(e for e in events if e[2] != D[0]) == [("1", "changed", D[1]), ("2", "disappeared", D[1]), ("2", "returned", D[3])]


def test_closed_record_keeps_the_day_before(spark):
    state, _, _ = run(spark, [(D[0], "a", [(1, "x"), (2, "y")]), (D[2], "a", [(1, "x")])])
    assert state["2"]["last_seen"] == D[0] and state["2"]["disappeared_at"] == D[2] and not state["2"]["is_present"]


def test_handover_is_suspect_and_bumps_nothing(spark):
    state, events, verdicts = run(spark, [(D[0], "a", [(1, "x"), (2, "y")]), (D[1], "b", [(1, "x3")])])
    assert verdicts[1].suspect and verdicts[1].missing == 1 and verdicts[1].disappeared == 0
    assert state["1"]["revision_no"] == 1 and state["1"]["last_source"] == "b" and state["2"]["is_present"]
    assert ("2", "absent", D[1]) in events


@pytest.mark.parametrize(("gap", "kept", "suspect"), [(1, 90, True), (31, 95, False), (1, 98, False)])
def test_allowance_grows_with_the_gap(spark, gap, kept, suspect):
    limits = fold.Limits(least_rows=1)
    _, _, verdicts = run(spark, [(D[0], "a", [(i, "x") for i in range(100)]), (D[0] + timedelta(days=gap), "a", [(i, "x") for i in range(kept)])], limits)
    assert verdicts[1].suspect is suspect and verdicts[1].disappeared == (0 if suspect else 100 - kept)


def test_refusals(spark):
    with pytest.raises(fold.OutOfOrder):
        run(spark, [(D[0], "a", [(1, "x")]), (D[2], "a", [(1, "x")]), (D[1], "a", [(1, "x")])])
    with pytest.raises(fold.TooSmall):
        run(spark, [(D[0], "a", [(1, "x")])], fold.Limits())


def test_stage_rejects_null_keys_and_is_deterministic(spark):
    raw = spark.createDataFrame([("1", "b"), ("1", "a"), (None, "c"), (None, "d"), ("2", None)], "id string, nz string")
    staged = stage.stage(raw)
    assert staged.stats == {"rows_raw": 5, "rows_dupe_id": 1, "rows_without_id": 2, "record_count": 2}
    assert staged.rejected.count() == 2 and "ovd" in staged.missing
    again = stage.stage(raw.orderBy(F.desc("nz")))
    assert sorted(staged.snapshot.collect()) == sorted(again.snapshot.collect())


def test_same_day_again_is_allowed(spark):
    state, _, _ = run(spark, [(D[0], "a", [(1, "x")]), (D[0], "a", [(1, "x2"), (2, "y")])])
    assert state["1"]["revision_no"] == 2 and state["2"]["first_seen"] == D[0]


def direct(series, trusted):
    """The truth table, one record at a time."""
    state, prev = {}, None
    for (day, source, rows), trust in zip(series, trusted):
        here = dict(rows)
        for k, v in here.items():
            r = state.get(k)
            if r is None:
                state[k] = {"h": v, "first_seen": day, "last_seen": None, "disappeared_at": None, "returned_at": None, "is_present": True, "revision_no": 1, "disappeared_count": 0, "first_source": source, "last_source": source}
                continue
            changed = r["h"] != v
            if changed and prev and prev[1] == source:
                r["revision_no"] += 1
            if not r["is_present"]:
                r["returned_at"] = day
            if changed or not r["is_present"]:
                r |= {"h": v, "is_present": True, "last_seen": None, "disappeared_at": None, "last_source": source}
        if trust:
            for k, r in state.items():
                if k not in here and r["is_present"]:
                    r |= {"is_present": False, "disappeared_at": day, "last_seen": prev[0] if prev else day, "disappeared_count": r["disappeared_count"] + 1}
        prev = (day, source)
    return state


def test_closed_form_agrees_with_the_truth_table(spark):
    rng = random.Random(7)
    keys = range(300)
    series = [(D[2 * i], rng.choice("ab"), [(k, rng.choice("uvw")) for k in keys if rng.random() < 0.6]) for i in range(9)]
    trusted = [rng.random() < 0.6 for _ in series]
    presences = spark.createDataFrame([(str(k), day, v) for day, _, rows in series for k, v in rows], "record_key string, day date, content_hash string")
    calendar = spark.createDataFrame([(day, s, t) for (day, s, _), t in zip(series, trusted)], "day date, source string, trusted boolean")
    got = {r["record_key"]: r.asDict() for r in closed_form.fold_series(presences, calendar).collect()}
    want = direct(series, trusted)
    assert set(got) == {str(k) for k in want}
    for k, r in want.items():
        for f, v in r.items():
            assert got[str(k)]["content_hash" if f == "h" else f] == v, (k, f)


def test_asof_is_strict(spark):
    calendar = spark.createDataFrame([(D[0],), (D[5],), (D[9],)], "snapshot_date date")
    rows = spark.createDataFrame([(1, D[0]), (2, D[5]), (3, D[6]), (4, D[20]), (5, None)], "k int, first_seen date")
    got = {r["k"]: r["first_seen_after"] for r in fold.with_asof(rows, calendar, "first_seen", "first_seen_after").collect()}
    assert got == {1: None, 2: D[0], 3: D[5], 4: D[9], 5: None}
