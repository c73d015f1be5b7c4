"""Session settings, the scratch folder and stored intermediates."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from skygauge.operators.joins import total_bytes
from skygauge.session import SESSION_SETTINGS, materialize, scratch_root


class Conf(dict):
    def set(self, key, setting):
        self[key] = setting


def session(**settings):
    return SimpleNamespace(conf=Conf({k.replace("__", "."): v for k, v in settings.items()}))


def test_cluster_folder_is_used_as_set():
    assert scratch_root(session(spark__checkpoint__dir="hdfs://shared/x", spark__master="yarn")) == "hdfs://shared/x"


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session(spark__master="spark://host:7077"))


def test_local_master_makes_one_folder():
    local = session(spark__master="local[2]")
    assert scratch_root(local) == scratch_root(local)


def test_settings_hold(spark):
    for key, setting in SESSION_SETTINGS.items():
        assert spark.conf.get(key) == setting


def test_stored_table_is_measured_and_fixed(spark):
    df = spark.range(1000).select((F.col("id") % 10).cast("string").alias("s"), F.rand().alias("r"))
    stored = materialize(df, "test", size=total_bytes(df), ones=F.count_if(F.col("s") == "1"))
    assert (stored.rows, stored.measures["ones"]) == (1000, 100)
    assert stored.measures["size"] == 1000 * (16 + 2 * 8 + 1)
    assert stored.table.agg(F.sum("r")).first() == stored.table.agg(F.sum("r")).first()


def test_empty_table_is_measured(spark):
    df = spark.range(0).select("id")
    stored = materialize(df, "empty", size=total_bytes(df))
    assert (stored.rows, stored.measures["size"], stored.table.count()) == (0, 0, 0)
    nothing = materialize(df.filter("false"), "empty", size=total_bytes(df))
    assert (nothing.rows, nothing.table.count()) == (0, 0)
