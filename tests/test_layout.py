"""The optional subpackage stays optional."""

from __future__ import annotations

import re
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_else_imports_the_training_data_subpackage():
    others = [p for p in ROOT.rglob("*.py") if "llm" not in p.parts and p.name not in ("corpus_pipeline.py", "__spark_entry__.py", "test_layout.py")]
    assert others and not [p for p in others if re.search(r"\bllm\b", p.read_text())]


def test_entry_point_works_without_it(monkeypatch):
    import __spark_entry__ as entry

    def missing(name):
        raise ModuleNotFoundError(name=name)

    monkeypatch.setattr(entry.importlib, "import_module", missing)
    assert len(entry.queries()) > 70 and not [n for n in entry.queries() if re.match(r"op\d", n)]
    assert set(entry.oracle_sql()) <= set(entry.queries())
