"""`python -m driftsweep` in a fresh process, from outside the repository."""

import ast
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_end_to_end(tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.csv").write_text("EmailAddress,FirstName,CID\nx@y,Ann Lee,C1\nz@y,Bob,C2\n")
    (inbox / "bad.csv").write_text("")
    env = dict(os.environ, PYTHONPATH=ROOT, PYSPARK_SUBMIT_ARGS="--conf spark.ui.enabled=false pyspark-shell")
    out = subprocess.run([sys.executable, "-m", "driftsweep", "--inbox", str(inbox), "--out", str(tmp_path / "out"),
                          "--run-id", "r1"], cwd=str(tmp_path), env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    result = ast.literal_eval(out.stdout.strip().splitlines()[-1])
    assert result == {"entries": 2, "errors": 1, "silver_rows": 2, "gold_rows": 2}
