"""Task failures (first attempts raise, as after an executor loss) do not
change results: versions written, salted joins and stream ingest are
exactly-once. Runs in a subprocess because it needs a session that retries
tasks (master local[4,4])."""

import json
import os
import subprocess
import sys


def test_results_survive_task_failures():
    script = os.path.join(os.path.dirname(__file__), "faults", "run_with_failures.py")
    p = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=900)
    lines = [x for x in p.stdout.splitlines() if x.startswith("RESULT ")]
    assert lines, p.stdout[-2000:] + p.stderr[-4000:]
    r = json.loads(lines[-1][len("RESULT "):])
    assert r["injected_failures"] >= 3          # each of the three jobs lost a task
    assert r["version_rows"] == r["version_distinct"] == r["expected_rows"]
    assert r["salted_equal"]
    assert r["stream_rows"] == r["stream_distinct"] == r["stream_expected"]
