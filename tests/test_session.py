"""Scratch tables live as long as their application."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from tallyward import session as S
from tallyward.operators import bootstrap as B
from tallyward.operators import causal as C

SCRIPT = """
import sys
from tallyward.session import build_session, materialize, scratch_folder
spark = build_session("scratch", "local[1]", **{"spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[1], "spark.sql.shuffle.partitions": "1"})
df = materialize(spark.range(5), "kept")
assert df.count() == 5
print(scratch_folder(spark))
if sys.argv[2] == "stop":
    spark.stop()
"""


def test_an_ended_driver_leaves_no_scratch(tmp_path):
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for how in ("stop", "leave"):
        run = subprocess.run(
            [sys.executable, "-c", SCRIPT, str(tmp_path), how], capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": top}
        )
        assert run.returncode == 0, run.stderr[-2000:]
        folder = run.stdout.strip().splitlines()[-1]
        assert folder.startswith(str(tmp_path)) and not os.path.exists(folder)


def test_scratch_is_cleared_on_request_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "shared_root", lambda _: str(tmp_path))
    df = S.materialize(spark.range(3), "numbers")
    folder = S.scratch_folder(spark)
    assert df.count() == 3 and os.listdir(folder)
    S.clear_scratch(spark)
    assert not os.path.exists(folder)


def test_fits_tell_whether_they_converged(spark):
    n = F.col("id")
    df = spark.range(200).select("id", (n % 2).cast("int").alias("a"), (n % 3 == 0).cast("int").alias("y"), (n % 7).cast("double").alias("x"))
    state = C.fit_state(C.fit_logit(df, "y", ["x"])).first()
    assert state.converged and state.iterations < 25
    parted = df.withColumn("y", (F.col("x") > 3).cast("int"))
    assert not C.fit_state(C.fit_logit(parted, "y", ["x"])).first().converged
    reps = B.bootstrap_aipw(df, "id", "a", "y", ["x"], reps=4).collect()
    assert all(r.converged for r in reps)
    assert not any(r.converged for r in B.bootstrap_aipw(df, "id", "a", "y", ["x"], reps=4, max_iter=1).collect())
