"""Tasks that fail once and run again must not lose, repeat or reorder rows."""

from __future__ import annotations

import os
import subprocess
import sys


def test_jobs_survive_failed_attempts(tmp_path):
    script = os.path.join(os.path.dirname(__file__), "retry_script.py")
    done = subprocess.run(
        [sys.executable, script, str(tmp_path / "target")],
        capture_output=True,
        text=True,
        timeout=300,
        check=False,
    )
    assert "survived" in done.stdout, done.stderr[-3000:]
