import json
import os
import subprocess
import sys

from conftest import ROOT
from test_sources import LINES, write_logs


def _run(*args):
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run([sys.executable, "-m", "logscan", "--master", "local[2]", *args], env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_fit_then_detect(tmp):
    train = os.path.join(tmp, "train")
    for i in range(6):
        write_logs(train, f"{i}.csv", LINES)
    model = os.path.join(tmp, "model")
    res = _run("fit", "--input", train, "--model", model, "--k", "4")
    version, = os.listdir(os.path.join(model, "versions"))  # layers and threshold of the one version
    assert res["threshold"] is not None and os.path.isdir(os.path.join(model, "versions", version, "layers"))
    uploads = os.path.join(tmp, "uploads")
    write_logs(uploads, "a.csv", LINES)
    out = _run("detect", "--input", uploads, "--model", model, "--result", os.path.join(tmp, "res"),
               "--metrics-path", os.path.join(tmp, "met"), "--consume")
    assert out["status"] == "ok" and out["total_logs"] == 4.0
    assert os.listdir(uploads) == []


def test_stream_and_catalogue(tmp):
    train = os.path.join(tmp, "train")
    for i in range(4):
        write_logs(train, f"{i}.csv", LINES)
    model = os.path.join(tmp, "model")
    _run("fit", "--input", train, "--model", model, "--k", "4")
    landing = os.path.join(tmp, "landing")
    write_logs(landing, "1-a.csv", LINES)
    out = _run("stream", "--input", landing, "--model", model, "--result", os.path.join(tmp, "res"),
               "--checkpoint", os.path.join(tmp, "ckpt"), "--available-now", "--threshold", "0")
    assert out["last_progress"] is not None
    events = os.path.join(tmp, "events")
    os.makedirs(events)
    with open(os.path.join(events, "e.json"), "w") as f:
        f.write(json.dumps({"filePath": "/u/a.csv", "fileName": "a.csv", "uploadTime": 1}) + "\n{bad\n")
    _run("catalogue", "--input", events, "--catalogue", os.path.join(tmp, "cat"),
         "--rejects", os.path.join(tmp, "rej"), "--checkpoint", os.path.join(tmp, "ckpt2"), "--available-now")
    assert os.path.isdir(os.path.join(tmp, "cat")) and os.path.isdir(os.path.join(tmp, "rej"))
