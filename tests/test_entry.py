"""The library without its optional parts."""

import os
import re
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

BLOCKED = """
import sys

class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in {"corpus_pipeline", "tripweave.llm"} or name.startswith("tripweave.llm."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""


def test_entry_works_without_the_training_data_operators():
    found = subprocess.run([sys.executable, "-c", BLOCKED], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stderr
    n_queries, n_sql = map(int, found.stdout.split()[-2:])
    assert n_queries == n_sql > 55


def test_nothing_else_imports_them():
    for folder, _, names in os.walk(f"{ROOT}/tripweave"):
        if folder.endswith("/llm") or "/llm/" in folder:
            continue
        for name in names:
            if name.endswith(".py"):
                with open(f"{folder}/{name}") as file:
                    assert not re.search(r"tripweave\.llm|from \.*llm|corpus_pipeline", file.read()), name
