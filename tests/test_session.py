import os
import subprocess
import sys

from dockcast.session import ensure_checkpoint_dir, table_folder

SCRIPT = """
import sys
from dockcast.operators.dims import materialise
from dockcast.session import get_spark
spark = get_spark("local[1]", 1, extra={"spark.checkpoint.dir": sys.argv[1]})
assert materialise(spark.range(10)).count() == 10
spark.stop()
"""


def test_tables_are_new_folders_of_one_that_exists(spark):
    a, b = table_folder(spark), table_folder(spark)
    assert a != b and os.path.dirname(a) == os.path.dirname(b) and a.startswith(ensure_checkpoint_dir(spark))
    assert os.path.isdir(os.path.dirname(a)) and not os.path.exists(a)


def test_tables_go_when_the_session_ends(tmpdir_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", SCRIPT, tmpdir_path], cwd=root, check=True, timeout=120, capture_output=True)
    assert os.listdir(f"{tmpdir_path}/dockcast-tables") == []
