import re
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[2]


def test_one_query_for_each_operator_and_the_pipeline():
    names = [n for n in entry.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert sorted(re.match(r"op\d+|pipeline", n)[0] for n in names) == sorted([*(f"op{n}" for n in range(1, 14)), "pipeline"])
    assert {"op2_tool_calls", "op8_arc_to_warc", "op11_dialogues", "op13_lexical_search"} <= set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_the_subpackage():
    others = [p for p in ROOT.glob("panelspark/**/*.py") if "llm" not in p.parts] + [ROOT / "bench.py", ROOT / "run.py"]
    assert others and not [p for p in others if "llm" in p.read_text()]
