"""Hand-made fixtures: empty input, one row per group, all-null group, null
key, duplicate order key, zero denominators, inf, unseen category, leap day,
week crossing a year end, two holidays on one date, gap in time."""
import datetime as dt
import math

from pyspark.sql import functions as F

from tessera.functions import calendar as C
from tessera.functions import columns as P
from tessera.operators import aggregates as A
from tessera.operators import joins as J
from tessera.operators import setops as U
from tessera.operators import windows as W


def test_panel_summary_single_row_and_null_last(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (2, 1, 1.0), (2, 2, None)], "k long, t long, v double")
    out = {r["k"]: r for r in A.panel_summary(df, "k", "v", ["t"]).collect()}
    assert out[1]["n"] == 1 and out[1]["range"] == 0.0 and out[1]["std"] == 0.0 and out[1]["pct_above_mean"] == 0.0
    assert out[2]["last"] is None and out[2]["n"] == 1          # positional last keeps the null


def test_panel_summary_empty_input(spark):
    df = spark.createDataFrame([], "k long, t long, v double")
    assert A.panel_summary(df, "k", "v", ["t"]).count() == 0


def test_multi_agg_all_null_sum_is_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0)], "k long, v double")
    out = {r["k"]: r["v_sum"] for r in A.multi_agg(df, "k", {"v": ["sum"]}).collect()}
    assert out[1] == 0 and out[2] == 3.0


def test_pct_change_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 5.0), (1, 3, None), (1, 4, 10.0)], "k long, t long, v double")
    out = [r["pc"] for r in W.pct_change(df, "v", ["k"], ["t"], "pc").orderBy("t").collect()]
    assert out[0] is None and out[1] is None          # first row, then 5/0
    assert out[2] == 0.0 and out[3] == 1.0            # null padded forward, then 10/5-1


def test_duplicate_flags_with_null_key(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a"), (5, "b")], "id long, c string")
    out = {r["id"]: r["is_duplicate"] for r in U.duplicate_flags(df, ["c"], ["id"]).collect()}
    assert out == {1: 0, 2: 1, 3: 0, 4: 1, 5: 0}


def test_feature_match_null_safe_and_no_fanout(spark):
    train = spark.createDataFrame([(None, 1, 1), (None, 1, 0), (2, 2, 1)], "a long, b long, y int")
    test = spark.createDataFrame([(None, 1), (3, 3)], "a long, b long")
    out = J.feature_match(test, train, ["a", "b"], "y").collect()
    assert len(out) == 2
    hit = [r for r in out if r["a"] is None][0]
    assert hit["n_train"] == 2 and hit["train_target"] == 0.5


def test_drop_inf_and_null_columns(spark):
    df = spark.createDataFrame([(1.0, float("inf"), None), (2.0, 1.0, 1.0)], "a double, b double, c double")
    assert P.drop_inf_columns(df, ["a", "b", "c"]).columns == ["a", "c"]
    assert P.drop_null_columns(df, ["a", "b", "c"]).columns == ["a", "b"]


def test_unseen_category(spark):
    tr = spark.createDataFrame([("x",), ("y",)], "c string")
    te = spark.createDataFrame([("y",), ("z",)], "c string")
    out = {r["c"]: r["in_train"] for r in U.unseen_categories(te, tr, "c").collect()}
    assert out == {"y": 1, "z": 0}


def test_calendar_leap_day_week_and_easter(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(2024, 3, 1),), (dt.date(2023, 3, 1),),
                                (dt.date(2020, 12, 31),)], "d date")
    r = df.select(C.leap_aligned_doy("d").alias("doy"), C.easter_date(F.year("d")).alias("e"),
                  F.date_add(F.date_trunc("week", "d").cast("date"), 6).alias("week_end")).collect()
    assert [x["doy"] for x in r][:3] == [60, 60, 60]
    assert r[0]["e"] == dt.date(2024, 3, 31) and r[3]["e"] == dt.date(2020, 4, 12)
    assert r[3]["week_end"] == dt.date(2021, 1, 3)                 # week crossing the year end
    assert df.select(C.repair_day(F.lit(2023), F.lit(2), F.lit(30))).first()[0] == 28


def test_two_holidays_on_one_date_do_not_fan_out(spark):
    years = spark.createDataFrame([(2020,)], "year int")
    h = C.holiday_table(years)
    rows = spark.createDataFrame([(1, 1, dt.date(2020, 1, 1))], "id long, n_regionkey int, date date")
    out = J.holiday_join(rows, h, ["n_regionkey", "date"]).collect()
    assert len(out) == 1 and out[0]["n_holidays"] == 2


def test_previous_period_with_gap(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (1, 2, 11.0), (1, 4, 13.0)], "k long, p long, v double")
    out = {r["p"]: r["v_prev"] for r in J.previous_period(df, ["k"], "p", ["v"]).collect()}
    assert out == {1: None, 2: 10.0, 4: None}


def _level_shift_walk(var, first_i=37, last_i=3, frac=0.2):
    """The walk as it is told, one series in numpy."""
    import numpy as np
    var = np.array(var, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        for i in range(min(first_i, len(var) - 1), last_i - 1, -1):
            if abs(var[i] - var[i - 1]) >= frac * np.mean(var[:i]):
                var[:i] *= var[i] / var[i - 1]
    if len(var) > 1:
        var[0] = var[1] * 0.99
    return var


def test_level_shift_matches_the_walk(spark):
    """Series shorter than the walk, of one row, with zeros and negative
    values, and one of 20,000 rows."""
    import random
    rnd = random.Random(3)
    series = {}
    for k in range(9):
        v, own = 10.0, []
        for t in range((40, 40, 40, 12, 1, 2, 40, 25, 20000)[k]):
            v = v * (1.5 if rnd.random() < 0.1 else 0.95) * (1 + rnd.uniform(-0.02, 0.02)) if k < 8 else 10.0 + t % 7
            own.append(0.0 if k == 6 and t % 9 == 4 else -v if k == 7 and t % 5 == 2 else v)
        series[k] = own
    df = spark.createDataFrame([(k, t, v) for k, own in series.items() for t, v in enumerate(own)],
                               "k long, t long, v double").repartition(4)
    fixed = W.level_shift_repair(df, "k", ["t"], "v", "repaired")
    got = {(r["k"], r["t"]): r["repaired"] for r in fixed.collect()}
    assert len(got) == sum(map(len, series.values()))
    for k, own in series.items():
        for t, want in enumerate(_level_shift_walk(own)):
            assert (math.isnan(want) and math.isnan(got[k, t])) or math.isclose(got[k, t], want, rel_tol=1e-9)
    assert "FlatMapGroupsInPandas" not in fixed._jdf.queryExecution().executedPlan().toString()


def test_asof_next_with_hot_probe_value(spark):
    """A third of the probes share one key; result equals a brute-force
    'smallest reference key >= probe key' lookup."""
    import random
    rnd = random.Random(1)
    ref = spark.createDataFrame([(float(k), float(k) * 10) for k in range(0, 200, 3)], "k double, v double")
    probes = [(i, 50.0 if i % 3 == 0 else float(rnd.randint(0, 210))) for i in range(900)]
    pr = spark.createDataFrame(probes, "id long, k double")
    out = {r["id"]: r["nv"] for r in J.asof_next(pr, ref, "k", "v", "nv", slices=7).collect()}
    refs = sorted(range(0, 200, 3))
    for i, k in probes:
        nxt = [x for x in refs if x >= k]
        assert out[i] == (nxt[0] * 10.0 if nxt else None)
