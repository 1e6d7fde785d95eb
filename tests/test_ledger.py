"""Jobs that were cut off go on behind their last finished stage."""

import numpy as np
import pytest
from helpers import ONE, series, to_spark

from meterflow.plans import forecasting as plan
from meterflow.plans.ledger import StageLedger, files_fingerprint
from meterflow.sources.sinks import write_clean


def readings(spark, n=400):
    frame = series(n, 3)
    rng = np.random.default_rng(4)
    for c in ("Temperature", "Humidity", "Wind_Speed", "Avg_Past_Consumption"):
        frame[c] = rng.normal(size=n).round(3)
    return to_spark(spark, frame.assign(Anomaly_Label="Normal"))


def test_a_killed_job_resumes_and_a_changed_one_starts_anew(spark, tmp_path, monkeypatch):
    source = write_clean(readings(spark), str(tmp_path / "raw"), file_format="csv")
    folder, out = str(tmp_path / "ledger"), str(tmp_path / "out")

    def killed(*_):
        raise KeyboardInterrupt
    first = StageLedger(spark, folder)
    with monkeypatch.context() as patch:
        patch.setattr(plan, "run_forecast", killed)
        with pytest.raises(KeyboardInterrupt):
            plan.run_job(spark, source, out, spec=ONE, ledger=first)
    assert first.written == ["features", "clean"]
    second = StageLedger(spark, folder)
    card = plan.run_job(spark, source, out, spec=ONE, ledger=second).first()
    assert second.written == ["predictions"] and card.rows == 60
    plain = plan.run_job(spark, source, out, spec=ONE).first()
    assert plain == card
    other = StageLedger(spark, folder)
    plan.run_job(spark, source, out, model="prophet", spec=ONE, ledger=other)
    assert other.written == ["predictions"]
    before = files_fingerprint(spark, source)
    write_clean(readings(spark, 380), source, file_format="csv")
    assert files_fingerprint(spark, source) != before
    changed = StageLedger(spark, folder)
    plan.run_job(spark, source, out, spec=ONE, ledger=changed)
    assert changed.written == ["features", "clean", "predictions"]


def test_an_unfinished_stage_is_written_again(spark, tmp_path):
    ledger = StageLedger(spark, str(tmp_path))
    stage = ledger.stage("numbers", ["x"], 1, lambda: spark.range(3))
    (next(tmp_path.glob("numbers-*")) / "_SUCCESS").rename(tmp_path / "gone")
    again = StageLedger(spark, str(tmp_path))
    assert again.stage("numbers", ["x"], 1, lambda: spark.range(4)).table.count() == 4 and again.written == ["numbers"]
    assert again.stage("numbers", ["x"], 1, lambda: spark.range(5)).mark == stage.mark and again.written == ["numbers"]
