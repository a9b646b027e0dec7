"""Scratch output follows the cluster's shared checkpoint folder."""

import os
import subprocess
import sys
import textwrap
import time


def test_shared_dir_uses_configured_checkpoint_dir(tmp_path):
    base = tmp_path / "shared"
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
        from pyspark.sql import SparkSession
        from tablekit.session import shared_dir
        s = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", {str(base)!r}).getOrCreate())
        p = shared_dir(s, "snapshots", "t", unique=True)
        print("PATH", p)
        print("CKPT", s.sparkContext.getCheckpointDir())
        s.stop()
    """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    lines = dict(line.split(" ", 1) for line in out.stdout.splitlines()
                 if line.startswith(("PATH ", "CKPT ")))
    assert str(base) in lines["PATH"] and str(base) in lines["CKPT"], out.stderr[-2000:]
    assert "/snapshots/t-" in lines["PATH"]


def test_scratch_goes_when_the_application_ends(tmp_path):
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
        from pyspark.sql import SparkSession
        from tablekit.session import shared_dir
        s = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
        p = shared_dir(s, "scratch", "t", unique=True)
        s.range(3).write.parquet(p)
        print("PATH", p)
        s.stop()
    """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    path = next(x for x in out.stdout.splitlines() if x.startswith("PATH ")).split(" ", 1)[1]
    assert path.startswith("file:")
    deadline = time.time() + 60                      # the JVM ends a little after Python
    while os.path.exists(path.removeprefix("file:")) and time.time() < deadline:
        time.sleep(0.5)
    assert not os.path.exists(path.removeprefix("file:"))


def test_a_cluster_without_a_shared_folder_is_an_error():
    import pytest
    from tablekit import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(), "x")


def test_tune_leaves_the_callers_settings(spark):
    from tablekit.session import tune
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        tune(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_scale_confs_are_strings():
    from tablekit.session import scale_confs
    assert all(isinstance(v, str) for v in scale_confs(1 << 30, 16).values())


def test_udfs_run_when_workers_cannot_import_the_package(tmp_path):
    """From another working directory the Python workers do not see the repo:
    the pandas UDF still runs (pickled by value), and after ship_package a
    worker can import tablekit."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {repo!r})
        from pyspark.sql import SparkSession, functions as F
        s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        from tablekit.plans import QUERIES
        print("SLOTS", QUERIES["udf_scalar_pandas"](s, "/root/testdata/sf0.001").count())
        from tablekit.session import ship_package
        ship_package(s)

        @F.udf("string")
        def version(x):
            import tablekit
            return tablekit.__version__

        print("SHIPPED", s.range(2).select(version("id")).first()[0])
        s.stop()
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         timeout=300, cwd=str(tmp_path), env=env)
    assert "SLOTS 6000" in out.stdout, out.stderr[-3000:]
    assert "SHIPPED 0.1.0" in out.stdout, out.stderr[-3000:]


def test_entry_survives_what_the_optional_queries_lack():
    """A missing module or data file of the optional part leaves all other queries."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for hack in ("sys.modules['xxhash'] = None", "sys.modules['corpus_pipeline'] = None",
                 "import importlib.resources as r; old = r.files; r.files = lambda *a: old('no.such.package' if a == ('tablekit.llm',) else a[0])"):
        code = f"import sys; {hack}; import __spark_entry__ as E; q = E.queries(); print(len(q), any(k.startswith('op') for k in q))"
        out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
        from tablekit import plans

        assert out == [str(len(plans.QUERIES)), "False"], hack


def test_shipped_package_has_code_and_data_files(spark):
    import glob
    import zipfile

    from tablekit import session

    session._SHIPPED.discard(spark.sparkContext.applicationId)
    session.ship_package(spark)
    newest = max(glob.glob(f"{session.tempfile.gettempdir()}/tk-pyfiles-*/tablekit.zip"), key=session.os.path.getmtime)
    names = zipfile.ZipFile(newest).namelist()
    assert "tablekit/session.py" in names and all(n.endswith((".py", ".txt")) for n in names)
