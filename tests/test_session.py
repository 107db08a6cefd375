import tempfile

import pytest

from starloom.session import discard, materialize, work_folder


class FakeConf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value or default


class FakeContext:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class FakeSession:
    def __init__(self, setting, master):
        self.conf, self.sparkContext = FakeConf(setting), FakeContext(master)


def test_work_folder_follows_the_setting():
    session = FakeSession("hdfs://shared/work/", "spark://host:7077")
    first, second = work_folder(session), work_folder(session)
    assert first.startswith("hdfs://shared/work/work-") and first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(FakeSession(None, "spark://host:7077"))
    assert work_folder(FakeSession(None, "local[2]")).startswith(tempfile.gettempdir())


def test_materialized_rows_are_read_back_and_discarded(spark, tmp_path):
    path = work_folder(spark)
    copy = materialize(spark.range(5), path)
    assert path in copy.inputFiles()[0] and copy.count() == 5
    with pytest.raises(Exception):
        materialize(spark.range(5), path)
    discard(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        discard(spark, str(tmp_path))
