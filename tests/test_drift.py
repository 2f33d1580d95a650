import pytest
from plans_seen import plan_of
from pyspark.sql import functions as F

from tidewatch.operators import drift as D
from tidewatch.operators import panel as P



def noise(n, level=100.0, seed=0):
    import numpy as np

    return list(level + np.random.default_rng(seed).normal(0, 1, n))


def batched(panel, days=90):
    return P.assign_batch(panel, days, F.lit("2024-01-01").cast("date"))


def flags(panel, rule=D.DriftRule(threshold=5.0)):
    return {r.batch_number: r.has_concept_drift for r in D.drift_flags(panel, rule).collect()}


def sizes(panel, rule=D.DriftRule(threshold=5.0)):
    got = D.window_sizes(D.training_windows(panel, rule)).collect()
    return {r.batch_number: (r.data_points, r.training_period_days, r.has_concept_drift) for r in got}


def test_level_shift_shortens_the_window_and_recovers(make_panel):
    """A shift in batch 6 is flagged while the reference still holds old days, and forgotten after that."""
    panel = batched(make_panel(noise(450) + noise(540, level=120, seed=1)))
    flagged = flags(panel)
    assert flagged[1] is False and flagged[5] is False
    assert flagged[6] is True and flagged[10] is False
    got = sizes(panel)
    assert got[1] == (90, 89, False)
    assert got[5] == (365, 364, False)
    assert got[6] == (180, 179, True)
    assert got[10] == (365, 364, False)


def test_short_history_in_drift_is_not_padded(make_panel):
    panel = batched(make_panel(noise(78) + noise(72, level=150)), days=78)
    assert sizes(panel)[2] == (150, 149, True)


def test_gap_widens_the_span_of_a_short_window(make_panel):
    ys = noise(90) + [None] * 90 + noise(90) + noise(90, level=160)
    got = sizes(batched(make_panel(ys)))
    assert got[4] == (180, 179, True)
    assert 2 not in got
    assert got[3] == (180, 269, False)


def test_constant_levels(make_panel):
    steady = flags(batched(make_panel([5.0] * 40), 10))
    assert not any(steady.values())
    stepped = flags(batched(make_panel([5.0] * 20 + [7.0] * 20), 10))
    assert stepped == {1: False, 2: False, 3: True, 4: True}


def test_detector_is_a_parameter(make_panel):
    panel = batched(make_panel(noise(20, 100) + noise(10, 103)), 10)
    rule = D.DriftRule(threshold=0.01, detector=lambda a, b: a.mean / b.mean - 1)
    assert flags(panel, rule)[3] is True
    assert flags(panel, D.DriftRule(threshold=0.5, detector=rule.detector))[3] is False


@pytest.mark.parametrize("long_rows,short_rows,days", [(365, 180, 90), (12, 5, 7), (4, 2, 9), (30, 10, 1)])
def test_windows_equal_brute_force(make_panel, long_rows, short_rows, days):
    import numpy as np

    rng = np.random.default_rng(days)
    ys = [None if rng.random() < 0.4 else float(rng.integers(1, 50)) for _ in range(150)]
    rule = D.DriftRule(threshold=1.0)
    panel = batched(make_panel(ys), days)
    flagged = flags(panel, rule)
    data = sorted((r.day, r.batch_number) for r in panel.collect())
    want = set()
    for n in {b for _, b in data}:
        visible = [d for d, b in data if b <= n]
        want |= {(n, d) for d in visible[-(short_rows if flagged[n] else long_rows) :]}
    windows = D.training_windows(panel, rule, long_rows, short_rows)
    got = [(r.batch_number, r.day) for r in windows.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_windows_need_one_shuffle_and_no_join(make_panel):
    plan = plan_of(D.training_windows(batched(make_panel([1.0] * 5))))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def test_episodes(spark):
    data = [("S001", "P001", n, n in (2, 3, 6)) for n in range(1, 8)]
    df = spark.createDataFrame(
        data, "store_id string, product_id string, batch_number int, has_concept_drift boolean"
    )
    got = {tuple(r)[2:] for r in D.drift_episodes(df).collect()}
    assert got == {(2, 3, 2), (6, 6, 1)}
