"""Interval link and 48h return against brute force on golden fixtures."""
import datetime as dt
import random

from pyspark.sql import functions as F

from wardflow.operators import link

D = dt.date(2025, 3, 10)


def ts(day_offset, h, m=0):
    return dt.datetime.combine(D + dt.timedelta(days=day_offset), dt.time(h, m))


def brute_link(visits, adms, max_days=1):
    best = {}
    for a_id, a_pat, a_ts in adms:
        cands = []
        for v_id, v_pat, v_day, v_ts in visits:
            if a_pat == v_pat and v_pat is not None and 0 <= (a_ts.date() - v_day).days <= max_days:
                mins = int((a_ts - v_ts).total_seconds() // 60) if a_ts >= v_ts else -int((v_ts - a_ts).total_seconds() // 60)
                cands.append((mins, v_id))
        if cands:
            best[a_id] = min(cands)[1]
    return best


def test_interval_link_fixture(spark):
    visits = [  # (visit, patient, day, arrival) — already one per patient-day
        (1, 100, D, ts(0, 8)), (2, 100, D + dt.timedelta(days=1), ts(1, 9)),
        (3, 200, D, ts(0, 10)), (4, 300, D, ts(0, 11)), (5, None, D, ts(0, 12)),
    ]
    adms = [  # (admission, patient, ts)
        (10, 100, ts(0, 7)),    # same day, before arrival → negative minutes first
        (11, 100, ts(1, 12)),   # D+1: candidates visit 1 (D) and 2 (D+1)
        (12, 200, ts(2, 1)),    # D+2: no candidate
        (13, 300, ts(1, 23)),   # D+1 of visit 4
        (14, 300, ts(0, 23)),   # same visit 4 linked to two admissions
        (15, None, ts(0, 12)),  # NULL patient never links
    ]
    v = spark.createDataFrame(visits, "vid long, pat long, day date, arr timestamp_ntz")
    a = spark.createDataFrame(adms, "aid long, apat long, ats timestamp_ntz")
    got = {r.aid: r.vid for r in link.interval_link(
        v, a, visit_id="vid", visit_patient="pat", visit_day="day", visit_ts="arr",
        adm_id="aid", adm_patient="apat", adm_ts="ats").collect()}
    assert got == brute_link(visits, adms) == {10: 1, 11: 2, 13: 4, 14: 4}


def test_interval_link_random_against_brute_force(spark):
    rnd = random.Random(7)
    visits, adms = [], []
    for p in range(30):
        for d in rnd.sample(range(10), 4):
            visits.append((len(visits) + 1, p, D + dt.timedelta(days=d), ts(d, rnd.randrange(24), rnd.randrange(60))))
        for _ in range(3):
            d = rnd.randrange(11)
            adms.append((1000 + len(adms), p, ts(d, rnd.randrange(24), rnd.randrange(60))))
    v = spark.createDataFrame(visits, "vid long, pat long, day date, arr timestamp_ntz")
    a = spark.createDataFrame(adms, "aid long, apat long, ats timestamp_ntz")
    got = {r.aid: r.vid for r in link.interval_link(
        v, a, visit_id="vid", visit_patient="pat", visit_day="day", visit_ts="arr",
        adm_id="aid", adm_patient="apat", adm_ts="ats").collect()}
    assert got == brute_link(visits, adms)


def test_returns_fixture(spark):
    rows = [  # (visit, patient, code, day offset)
        (1, 1, "A10", 0), (2, 1, "A10", 1), (3, 1, "A10", 2), (4, 1, "A10", 3),
        (5, 1, "B20", 0), (6, 1, None, 0), (7, 1, None, 1), (8, 2, "A10", 5), (9, 2, "A10", 5),
        (10, 3, "C1", 0), (11, 3, "C1", 3),
    ]
    df = spark.createDataFrame([(a, b, c, D + dt.timedelta(days=d)) for a, b, c, d in rows],
                               "vid long, pat long, cid string, day date")
    got = {r.vid: r.fl_retorno_48h for r in link.flag_returns(df, patient="pat", code="cid", day="day").collect()}
    # brute force: another visit of the same patient and code 1..2 days later
    exp = {}
    for a, p, c, d in rows:
        exp[a] = int(any(p2 == p and c is not None and c2 == c and 1 <= d2 - d <= 2 for _, p2, c2, d2 in rows))
    assert got == exp
    assert got[1] == got[2] == got[3] == 1 and got[4] == 0 and got[6] == 0 and got[8] == 0 and got[10] == 0


def test_top1_is_partial_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = link.top1(df, ["k"], [("v", "desc")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(r.v for r in link.top1(df, ["k"], [("v", "desc")]).collect()) == [997, 998, 999]


def test_returns_options_against_brute_force(spark):
    rnd = random.Random(17)
    rows = [(i, rnd.randrange(6), rnd.choice(["A", "B", None]), rnd.randrange(12)) for i in range(300)]
    df = spark.createDataFrame([(a, b, c, D + dt.timedelta(days=d)) for a, b, c, d in rows],
                               "vid long, pat long, cid string, day date")
    for mark in ("first", "return"):
        for same in (True, False):
            got = {r.vid: r.f for r in link.flag_returns(df, patient="pat", code="cid" if same else None,
                                                         day="day", flag="f", mark=mark).collect()}
            exp = {}
            for a, p, c, d in rows:
                def pair(c2, d2):
                    gap = (d2 - d) if mark == "first" else (d - d2)
                    return 1 <= gap <= 2 and (not same or (c is not None and c2 == c))
                exp[a] = int(any(p2 == p and pair(c2, d2) for _, p2, c2, d2 in rows))
            assert got == exp, (mark, same)
