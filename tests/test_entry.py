import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_works_without_the_training_data_operators():
    code = "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['leafmill.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(k.startswith('op') and k[2].isdigit() for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_them():
    for path in (ROOT / "leafmill").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "leafmill.llm" not in path.read_text()


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
