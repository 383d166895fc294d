"""Without the corpus subpackage and the pipeline file, everything else imports and lists its queries."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_the_rest_stands_alone(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "tideline", tmp_path / "tideline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 45 and set(e.oracle_sql()) <= set(q); assert not any(n.startswith('op') and n[2].isdigit() for n in q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
