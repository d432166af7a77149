import importlib.util
import os

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    df = _entry().entry(spark)
    assert df.columns == ["year", "est", "n"]
    rows = df.collect()
    years = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr("year(l_shipdate) AS y").distinct().count()
    assert 0 < len(rows) <= years and all(r.n > 0 and 0 < r.est < 60 for r in rows)


def test_every_oracle_has_a_query():
    mod = _entry()
    assert set(mod.oracle_sql()) <= set(mod.queries())
    survey_keys = set("""stations_clean obs_on_day within_radius idw_weights null_key_fill followers_of
        followees_of accuracy profile_numeric idw_yearly timeline_push timeline_pull idw_point profile_counts
        followers_sets following_sets posts_by_author timeline_ordered split_8020 haversine_km label_from_path
        strip_scheme img_resize img_raw img_convolve img_sobel img_laplace img_canny img_dilate img_scale
        nb_predict svc_predict mlp_predict fit_predict feed_upsert""".split())
    assert survey_keys <= set(mod.queries())


def _duck():
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _sql_queries():
    from corvid.plans.registry import all_queries
    return sorted(n for n, q in all_queries().items() if q.sql)


@pytest.mark.parametrize("name", _sql_queries())
def test_query_matches_oracle_sf0001(spark, name):
    import sys
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    from check_oracle import compare
    from corvid.plans.registry import all_queries
    r = compare(spark, _duck(), name, all_queries()[name], SF)
    assert r["status"] == "ok", r


def test_python_steps_run_without_package_on_workers(tmp_path):
    """The driver imports __spark_entry__.py from elsewhere; workers get no package."""
    import subprocess
    import sys
    code = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("e", {os.path.join(ROOT, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
for name in ["img_canny", "img_raw", "img_sobel", "fit_predict"]:
    print(name, m.queries()[name](spark, {SF!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env,
                       capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-3000:]
    assert [ln.split()[0] for ln in r.stdout.splitlines() if ln and ln[0].isalpha()][-4:] == \
        ["img_canny", "img_raw", "img_sobel", "fit_predict"]


def test_entry_without_the_training_data_files(tmp_path):
    """The entry still imports, with the other queries, where that subpackage and the pipeline are gone."""
    import shutil
    import subprocess
    import sys
    skip = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(os.path.join(ROOT, "corvid"), tmp_path / "corvid", ignore=skip)
    os.makedirs(tmp_path / "corvid" / "llm" / "__pycache__")  # a left-over folder is no subpackage
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), len(e.oracle_sql()))"
    r = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120,
                       env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    from corvid.plans.registry import all_queries
    sql = sum(bool(q.sql) for q in all_queries().values())
    assert r.stdout.split() == [str(len(all_queries())), "False", str(sql)], r.stderr[-2000:]
