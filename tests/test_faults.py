"""Lost tasks are recomputed to the same results (task retries in local mode)."""

import json
import os
import subprocess
import sys

import pytest

from conftest import ROOT, SF_MID


def test_results_survive_task_failures():
    env = dict(os.environ, PYTHONPATH=ROOT)
    p = subprocess.run([sys.executable, os.path.join(ROOT, "tests", "fault_job.py"), ROOT,
                        f"{SF_MID}/embeddings.parquet"], env=env, capture_output=True, text=True, timeout=900)
    assert p.returncode == 0, p.stderr[-3000:]
    res = json.loads(p.stdout.strip().splitlines()[-1])
    clean, faulty = res["False"], res["True"]
    assert faulty["n"] == clean["n"] == 500
    assert faulty["q"] == clean["q"] and faulty["ids"] == clean["ids"]
    assert faulty["loss"] == pytest.approx(clean["loss"], rel=1e-6)
    assert faulty["w0"] == pytest.approx(clean["w0"], rel=1e-6)
    assert faulty["sync_loss"] == clean["sync_loss"] and faulty["sync_w0"] == clean["sync_w0"]
