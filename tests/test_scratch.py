import pytest

from trilode.scratch import CHECKPOINT_DIR, shared_folder


class Conf(dict):
    def get(self, key, *default):
        return super().get(key, *default)


class Session:
    def __init__(self, **settings):
        self.conf = Conf({k.replace("_", "."): v for k, v in settings.items()})


def test_the_cluster_names_the_folder(spark):
    session = Session(spark_app_id="app-1", spark_checkpoint_dir="s3a://shared/", spark_master="yarn")
    assert shared_folder(session) == "s3a://shared/trilode/app-1"
    assert shared_folder(spark).startswith(spark.conf.get(CHECKPOINT_DIR))


def test_a_local_folder_only_on_a_local_master():
    assert "trilode" in shared_folder(Session(spark_app_id="a", spark_master="local[2]"))
    with pytest.raises(RuntimeError, match=CHECKPOINT_DIR):
        shared_folder(Session(spark_app_id="a", spark_master="spark://host:7077"))
