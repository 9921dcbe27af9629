import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parent.parent


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_has_rows(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["o_orderkey", "value", "confidence", "basis"] and df.count() > 0


def test_imports_without_the_text_operators():
    code = "import sys; sys.modules['attestor.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0


def test_nothing_else_imports_the_text_operators():
    for path in (ROOT / "attestor").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "attestor.llm" not in path.read_text() and "import llm" not in path.read_text()


def test_command_line(spark, tmp_path):
    from attestor.__main__ import main

    folder = "/root/testdata/sf0.001"
    assert main([], spark) == 0 and main(["nothing"], spark) == 2 and main(["by_frequency"], spark) == 2
    assert main(["by_frequency", "--tables", folder, "--out", f"file://{tmp_path}", "--where", "n > 0"], spark) == 0
    assert spark.read.parquet(f"file://{tmp_path}/by_frequency").count() > 0
    assert main(["unique_key_violations", "--tables", folder, "--limit", "1", "--fail-on-rows"], spark) == 1
    assert main(["unique_key_violations", "--tables", folder, "--where", "detail = 'x'", "--fail-on-rows"], spark) == 0
