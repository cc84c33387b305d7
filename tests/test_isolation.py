"""The text operators can be taken out."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_nothing_else_imports_the_subpackage():
    for path in [*ROOT.glob("tidemark/**/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.relative_to(ROOT).parts:
            assert "tidemark.llm" not in path.read_text(), path


def test_entry_without_it():
    code = "import sys; sys.modules['tidemark.llm'] = None; import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'p1_found' in q and 'p2_found' not in q and not set(s) - set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
