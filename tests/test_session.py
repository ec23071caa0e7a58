import os
import subprocess
import sys

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_workers_need_no_installed_package(folder):
    """Started elsewhere, without PYTHONPATH, with Python code in the workers."""
    code = f"""
import sys
sys.path.insert(0, {TOP!r})
from tickloom.session import build_session
spark = build_session("elsewhere", "local[2]", **{{"spark.sql.shuffle.partitions": "2"}})
import __spark_entry__
print("rows", __spark_entry__.entry(spark).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=300)
    assert "rows " in done.stdout, done.stderr[-2000:]


def test_queries_without_the_training_data_operators(folder):
    """The rest imports and lists its queries where those folders are missing."""
    import shutil

    shutil.copytree(f"{TOP}/tickloom", f"{folder}/tickloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{TOP}/__spark_entry__.py", folder)
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"],
                          cwd=folder, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
                          capture_output=True, text=True, timeout=120)
    assert done.stdout.split()[1:] == ["False"] and int(done.stdout.split()[0]) > 100, done.stderr


def test_stored_results_go_with_their_scope(spark):
    from tickloom.session import materialize, temporary

    with temporary(spark):
        gone = materialize(spark.range(5).toDF("x"))
        kept = materialize(gone, keep=True)
        paths = [df.inputFiles()[0].removeprefix("file:").replace("//", "/") for df in (gone, kept)]
        assert all(os.path.exists(p) for p in paths)
    assert [os.path.exists(p) for p in paths] == [False, True]
    assert kept.count() == 5
