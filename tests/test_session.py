import pytest

from ticksmith import session


class _Unset:
    """A session that names no shared folder."""

    def __init__(self, master):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.dir = None

    def get(self, key, default=None):
        return default

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


def test_no_shared_folder_raises():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_Unset("yarn"))


def test_only_a_local_master_gets_a_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Unset("yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Unset("local-cluster[2,1,1024]"))
    local = _Unset("local[2]")
    assert session.ensure_checkpoint_dir(local) == session.checkpoint_root(local) == local.dir


def test_staged_copies_have_an_owner_and_can_be_dropped(spark):
    before = session._own_root
    root = session.shared_path(spark, "owner-test")
    try:
        session._own_root = lambda s: root
        df = session.staged(spark.range(5), "numbers")
        assert df.count() == 5
        assert df.inputFiles()[0].startswith("file:") and root.removeprefix("file:") in df.inputFiles()[0]
        assert session.drop_staged(spark)
        assert not session.drop_staged(spark)
    finally:
        session._own_root = before
