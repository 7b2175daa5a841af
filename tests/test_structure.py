import ast
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_outside_the_subpackage_imports_it():
    for path in (ROOT / "landloom").rglob("*.py"):
        if "llm" in path.relative_to(ROOT / "landloom").parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path


def test_entry_lists_queries_with_and_without_sql():
    import __spark_entry__ as e

    q, s = e.queries(), e.oracle_sql()
    assert set(s) <= set(q)
    assert {"p3_found", "p4_found", "p5_found", "p6_found"} <= set(q)


def test_tables_in_the_shared_folder(spark, tmp_path):
    from landloom import runtime

    df = runtime.materialize(spark.range(5), "test")
    assert df.count() == 5 and df._landloom_path.startswith(runtime.shared_dir(spark))
    runtime.discard(df)
    assert df._landloom_path not in runtime._written
    kept = runtime.materialize(spark.range(3))
    runtime.release(spark)
    assert not runtime._written and kept._landloom_path
