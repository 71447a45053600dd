"""Without this subpackage and the pipeline the rest imports and keeps its queries."""

import os
import re
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_entry_without_the_subpackage(tmp_path):
    for name in ("knownwhen", "verification", "__spark_entry__.py", "bench.py"):
        path = os.path.join(HERE, name)
        if os.path.isdir(path):
            shutil.copytree(path, tmp_path / name, ignore=shutil.ignore_patterns(
                "llm", "__pycache__"))
        else:
            shutil.copy(path, tmp_path)
    out = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), "
         "len(e.oracle_sql()), [q for q in e.queries() if q.startswith('op')])"],
        cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    ours, sql, ops = out.stdout.split(" ", 2)
    assert int(ours) == int(sql) > 60 and ops.strip() == "[]"


def test_nothing_else_imports_it():
    for folder in ("knownwhen", "verification"):
        for top, _, names in os.walk(os.path.join(HERE, folder)):
            if os.path.basename(top) in ("llm", "__pycache__"):
                continue
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(top, name)) as source:
                        assert not re.search(r"\bllm\b", source.read()), name
