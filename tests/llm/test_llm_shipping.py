"""The operators run on executors that have no copy of the package: workers started elsewhere cannot import it."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
QUERIES = (
    "op4_decontamination op5_token_counts op6_bpe_round_trip op11_phrase_collocations op12_conversation_repair op13_lm_scoring"
).split()

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from stayline.session import build_session
spark = build_session("shipping", "local[2]", **{{
    "spark.sql.shuffle.partitions": "2", "spark.driver.memory": "2g", "spark.ui.enabled": "false"}})
def absent(batches):
    import importlib.util
    for batch in batches:
        assert importlib.util.find_spec("stayline") is None, "a worker can import the package"
        yield batch
spark.range(1).mapInArrow(absent, "id long").count()
import __spark_entry__
for name in {queries!r}:
    assert __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count() >= 0, name
print("all ran")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    pytest.importorskip("public_tokenizers")
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=str(ROOT), queries=QUERIES))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]
