import os
import subprocess
import sys

from conftest import ROOT

from vacancylens.session import configure, new_folder, shared_dir


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_configure_pins_the_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_session_without_setting_fails(tmp_path):
    code = (
        "from pyspark.sql import SparkSession; from vacancylens.session import shared_dir;"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate();"
        "shared_dir(s)"
    )
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path)}  # no defaults file
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=env, capture_output=True, text=True, timeout=120)
    assert "set spark.checkpoint.dir" in out.stderr
