"""The package runs where executors cannot import it."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from quotelane.session import build_session
from quotelane.plans.catalog import price_timer_conflation
from quotelane.plans.streams import stream_rolling_quantity
spark = build_session("away", "local[2]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false")
print(price_timer_conflation(spark, {sf!r}).count(), stream_rolling_quantity(spark, {sf!r}).count())
"""


def test_runs_from_another_folder(tmp_path):
    repo = str(Path(__file__).resolve().parents[1])
    script = tmp_path / "away.py"
    script.write_text(SCRIPT.format(repo=repo, sf="/root/testdata/sf0.001"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.split() == ["120", "798"]
