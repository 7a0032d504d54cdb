"""The llm subpackage can be taken away, and nothing else imports it."""

import re
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_nothing_imports_llm():
    for p in [*(ROOT / "evigraph").rglob("*.py"), *(ROOT / "tests").glob("*.py")]:
        if "llm" not in p.relative_to(ROOT).parts and p.name != "test_layout.py":
            assert not re.search(r"(?m)^\s*(?:from|import)\s+\S*\bllm\b", p.read_text()), p


def test_no_local_checkpoints():
    for p in (ROOT / "evigraph").rglob("*.py"):
        assert "localCheckpoint" not in p.read_text() and ".crossJoin(" not in p.read_text(), p
