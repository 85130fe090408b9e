"""The driver contract, with and without the corpus subpackage."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_every_oracle_has_a_query():
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry_imports_without_the_corpus_modules(tmp_path):
    for part in ("guidewave", "__spark_entry__.py"):
        (tmp_path / part).symlink_to(ROOT / part)
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'guidewave.llm'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(n.startswith('op') and n[2].isdigit() for n in e.queries()) and e.oracle_sql().keys() <= e.queries().keys()\n"
    )
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120)
