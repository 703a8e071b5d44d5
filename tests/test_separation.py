from __future__ import annotations

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent

BLOCKED = """
import sys
sys.modules[{name!r}] = None  # as if it could not be found
import __spark_entry__ as entry
assert "parsed_lines" in entry.queries() and "monthly_report" in entry.oracle_sql()
print(any(n.startswith("op") for n in entry.queries()))
"""


def run(name: str) -> str:
    code = BLOCKED.format(name=name)
    return subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, check=True).stdout.strip()


def test_trip_queries_do_without_the_removable_part_and_its_packages():
    for name in ("xxhash", "public_tokenizers", "corpus_pipeline", "tripmart.llm"):
        assert run(name).splitlines()[-1] == "False", name
    assert run("no_such_module").splitlines()[-1] == "True"
