import re
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_else_imports_the_corpus_operators():
    for path in (ROOT / "tidemark").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"tidemark\.llm|from tidemark import llm|corpus_pipeline", path.read_text()), path


def test_entry_works_without_them(tmp_path):
    shutil.copytree(ROOT / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 70 and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_every_oracle_has_its_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
