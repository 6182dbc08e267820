import os
import subprocess
import sys

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(*args):
    return subprocess.run([sys.executable, *args], cwd=TOP, capture_output=True, text=True, timeout=300)


def test_all_tests_collect_from_the_top():
    out = run("-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider")
    assert out.returncode == 0, out.stdout[-2000:]


def test_entry_imports_without_an_optional_package():
    out = run("-W", "ignore", "-c", "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; "
              "print(len(e.queries()), len(e.oracle_sql()), 'build_postings' in e.queries())")
    assert out.returncode == 0 and out.stdout.strip().endswith("True"), out.stderr[-2000:]
