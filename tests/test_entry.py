import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_mod  # noqa: E402
from tidings.plans.catalog import NO_ORACLE  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and set(df.columns) == {"name", "label", "n_probes", "avg_return"}


def test_every_query_has_oracle_or_is_listed():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    corpus = {k for k in q if k[:2] == "op" and k[2].isdigit() or k == "pipeline"}  # tested in tests/llm
    assert set(q) - set(o) - corpus == NO_ORACLE


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["asof_returns", "routed_events", "daily_features", "similar_documents",
                                  "signal_weights", "corr_matrix"])
def test_plans_have_no_cartesian_product(spark, name):
    df = entry_mod.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    p = _plan(df)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_filters_and_columns_reach_the_scan(spark):
    from pyspark.sql import functions as F
    from tidings.sources import standins as st
    d = st.table(spark, SF, "documents").where(F.col("lang") == "en").select("doc_id")
    p = d._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in p
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in p


@pytest.mark.parametrize("name", ["asof_returns", "routed_events", "daily_features", "series_returns",
                                  "classification_report", "signal_weights", "tfidf_vocabulary",
                                  "dedup_append", "sentiment_by_day"])
def test_oracle_parity_small(spark, name):
    import duckdb
    import math
    from tidings.sources.standins import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    s = entry_mod.queries()[name](spark, SF).toPandas()
    o = con.sql(entry_mod.oracle_sql()[name]).df()

    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(v, 6) if isinstance(v, float) else (v.item() if hasattr(v, "item") else v)

    cols = sorted(s.columns)
    assert cols == sorted(o.columns)
    rs = sorted((tuple(norm(x) for x in r) for r in s[cols].itertuples(index=False)), key=str)
    ro = sorted((tuple(norm(x) for x in r) for r in o[cols].itertuples(index=False)), key=str)
    assert rs == ro


def _python(code, cwd):
    import subprocess
    import sys
    return subprocess.run([sys.executable, "-c", code], cwd=cwd, capture_output=True, text=True, timeout=300)


def test_oracle_needs_no_jar():
    """All SQL builds where Spark's jars cannot be opened."""
    code = ("import sys\n"
            "def hook(event, args):\n"
            "    if event == 'open' and str(args[0]).endswith('.jar'): raise OSError('no jars here')\n"
            "sys.addaudithook(hook)\nsys.path.insert(0, '.')\n"
            "import __spark_entry__ as e\nq, o = e.queries(), e.oracle_sql()\n"
            "assert set(o) <= set(q) and len(o) >= 85, (set(o) - set(q), len(o))\n")
    r = _python(code, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert r.returncode == 0, r.stderr[-2000:]


def test_without_the_corpus_operators(tmp_path):
    import shutil
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/tidings", tmp_path / "tidings", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    r = _python("import sys; sys.path.insert(0, '.')\nimport __spark_entry__ as e\n"
                "assert len(e.queries()) > 90 and not [k for k in e.queries() if k.startswith('op') or k == 'pipeline']\n"
                "assert set(e.oracle_sql()) <= set(e.queries())", tmp_path)
    assert r.returncode == 0, r.stderr[-2000:]
