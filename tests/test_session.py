import os
import subprocess
import sys

from opscore.session import scale_conf


def test_scale_conf_100tb():
    c = scale_conf(100 * (1 << 40), 8000)
    assert c["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert int(c["spark.sql.shuffle.partitions"]) == 416000
    assert int(c["spark.sql.shuffle.partitions"]) % 8000 == 0
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_scale_conf_small_input_keeps_two_per_core():
    c = scale_conf(10 << 20, 8)
    assert c["spark.sql.files.maxPartitionBytes"] == str(128 << 20)
    assert int(c["spark.sql.shuffle.partitions"]) == 16


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.path.insert(0, %r)
from opscore.session import local_session, shared_folder
s = local_session(2, 4)
print("ROWS", s.range(5).count())
try:
    shared_folder(s)
except ValueError as e:
    print("RAISED", e)
s.sparkContext.setCheckpointDir(sys.argv[1])
print("FOLDER", shared_folder(s))
""" % ROOT


def test_session_starts_without_a_spark_configuration(tmp_path):
    """An empty conf folder: the session starts, and the shared folder is asked for, never made up."""
    conf = tmp_path / "conf"
    conf.mkdir()
    out = subprocess.run([sys.executable, "-c", CODE, str(tmp_path / "work")], capture_output=True, text=True,
                         timeout=300, env=os.environ | {"SPARK_CONF_DIR": str(conf)}).stdout
    assert "ROWS 5" in out and "RAISED" in out and str(tmp_path / "work") in out.split("FOLDER")[1]
