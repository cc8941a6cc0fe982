"""Workers need no installed package: queries run from a folder from which it can't be imported."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RUN = f"""
import sys
sys.path.insert(0, {ROOT!r})
from medalloy.session import local_session
from medalloy.llm.queries import QUERIES
spark = local_session(2, 4)
print("rows", *(QUERIES[q](spark, "/root/testdata/sf0.001").count() for q in ("op8_bpe_codec", "op12_periodic_runs", "op7_kernel_quality")))
"""


def test_queries_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", RUN], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 200 200 200" in done.stdout, done.stderr[-2000:]
