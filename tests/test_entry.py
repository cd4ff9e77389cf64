import __spark_entry__ as entry_mod


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "views_cnt" in df.columns


def test_every_oracle_has_its_query():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    # Rows only: the tree ensemble's numbers (held against a plain version in tests), and what
    # SQL cannot say.  No other query may go without an oracle.
    trees = {"tree_model_metrics", "propensity_scores", "model_comparison"}
    training = {"op2_toxicity", "op3_extract", "op8_language", "op9_decontamination", "pipeline"}
    assert set(q) - set(o) <= trees | training


def test_package_stands_alone(tmp_path):
    """Without the training-data subpackage and the pipeline the entry still works."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(entry_mod.__file__).parent
    keep = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(repo / "cartflow", tmp_path / "cartflow", ignore=keep)
    shutil.copy(repo / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and 'mart_funnel_daily' in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
