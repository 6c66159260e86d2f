"""The core library stands without the optional text operators."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1]


def test_nothing_outside_imports_the_text_operators():
    for f in (ROOT / "basketry").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT).parts:
            assert not re.search(r"basketry[./]llm|corpus_pipeline", f.read_text()), f
