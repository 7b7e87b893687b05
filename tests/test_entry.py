"""The entry point with and without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("gone", [["mlframe/llm"], ["mlframe/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_queries_without(gone, tmp_dir):
    skip = {os.path.join(ROOT, g) for g in gone}
    leave = lambda folder, names: [n for n in names if n in (".git", "__pycache__") or os.path.join(folder, n) in skip]
    for name in ("mlframe", "__spark_entry__.py", "corpus_pipeline.py"):
        src = os.path.join(ROOT, name)
        if src in skip or not os.path.exists(src):
            continue
        (shutil.copytree if os.path.isdir(src) else shutil.copy)(src, f"{tmp_dir}/{name}", **({"ignore": leave} if os.path.isdir(src) else {}))
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), set(s) <= set(q), 'training_set' in q)"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": tmp_dir})
    assert ran.returncode == 0, ran.stderr
    assert ran.stdout.split()[1:] == ["True", "True"]
