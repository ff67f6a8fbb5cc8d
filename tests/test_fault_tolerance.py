"""Ranks survive task retries (a lost executor): run the probe in its own
process, which needs its own SparkContext with ``local[N,maxFailures]``."""

import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_ranks_survive_task_retries():
    out = subprocess.run([sys.executable, os.path.join(HERE, "retry_probe.py")],
                         capture_output=True, text=True, timeout=600)
    assert out.stdout.strip().endswith("OK"), out.stdout[-2000:] + out.stderr[-4000:]
