import datetime

import pytest

from lakeloom.operators import leaderboard

T0, T1 = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 2, 1)


def log(spark, rows):
    return spark.createDataFrame(rows, "framework string, model_name string, version int, recorded_at timestamp_ntz, "
                                       "train_seconds double, metric string, value double")


def test_too_close_to_call_and_newest_run_only(spark):
    rows = []
    for fw, old, new in [("a", 0.1, 1.30), ("b", 5.0, 1.31), ("c", 9.0, 1.40)]:
        rows += [(fw, f"m_{fw}", 1, T0, 1.0, "score_rmse", old), (fw, f"m_{fw}", 2, T1, 1.0, "score_rmse", new)]
    b = {r["framework"]: r for r in leaderboard.board(log(spark, rows)).collect()}
    assert b["a"]["rank"] == 1 and b["a"]["is_champion"] and not b["b"]["is_champion"]
    assert {r["version"] for r in b.values()} == {2}
    assert b["a"]["verdict"] == "too close to call"


def test_single_entrant_and_null_score(spark):
    rows = [("a", "m", 1, T0, 1.0, "score_rmse", 2.0), ("b", "m", 1, T0, 1.0, "test_rmse", 1.0)]
    b = leaderboard.board(log(spark, rows)).collect()
    assert len(b) == 1 and b[0]["margin_pct"] == 100.0 and b[0]["verdict"] == "clear win"


def test_no_scores_is_an_error(spark):
    with pytest.raises(leaderboard.NoScores):
        leaderboard.board(log(spark, [("b", "m", 1, T0, 1.0, "test_rmse", 1.0)]))
