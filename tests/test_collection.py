"""Every test module can be collected, and every SQL text is text."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

TESTS = Path(__file__).resolve().parent


def test_every_module_collects():
    out = subprocess.run([sys.executable, "-m", "pytest", str(TESTS), "--collect-only", "-q", "-p", "no:cacheprovider"],
                         capture_output=True, text=True, timeout=300, cwd=TESTS.parent)
    assert out.returncode == 0, out.stdout[-2000:]
    for module in TESTS.rglob("test_*.py"):
        assert str(module.relative_to(TESTS)) in out.stdout, module


def test_one_conftest():
    assert [p.relative_to(TESTS).as_posix() for p in TESTS.rglob("conftest.py")] == ["conftest.py"]


def test_every_sql_is_text_of_a_query():
    names, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(names)
    assert all(isinstance(text, str) for text in sql.values())
    assert all(callable(q) for q in names.values())
