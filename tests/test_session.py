import pytest

from stratagauge.session import SETTINGS, scratch_dir, tune


class Session:
    """Only what `scratch_dir` asks of a session."""

    def __init__(self, master, folder=None):
        self.values = {"spark.checkpoint.dir": folder} if folder else {}
        self.conf = self.sparkContext = self
        self.master = master

    def get(self, name, default=None):
        return self.values.get(name, default)

    def getCheckpointDir(self):
        return None


def test_scratch_is_below_the_shared_folder():
    first, second = (scratch_dir(Session("spark://host:7077", "hdfs://shared/tmp/"), "x") for _ in range(2))
    assert first.startswith("hdfs://shared/tmp/x-") and first != second


def test_a_cluster_needs_the_shared_folder_and_a_local_session_does_not():
    with pytest.raises(ValueError):
        scratch_dir(Session("spark://host:7077"), "x")
    assert scratch_dir(Session("local[4]"), "x").startswith("/")


def test_settings_are_applied(spark):
    tune(spark)
    assert all(spark.conf.get(name) == value for name, value in SETTINGS.items())
