"""Where intermediate tables go, and that they go away."""

from pathlib import Path

import pytest

from tickerloom import scratch


class Session:
    """The settings of a session that isn't there."""

    def __init__(self, **settings):
        self.settings = {name.replace("__", "."): value for name, value in settings.items()}
        self.conf = self

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_the_folder_that_the_session_names():
    assert scratch.scratch_root(Session(spark__checkpoint__dir="s3://shared/x/", spark__master="yarn")) == "s3://shared/x"
    local = Session(spark__master="local[4]", spark__sql__warehouse__dir="/w")
    assert scratch.scratch_root(local) == "/w/_scratch"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", None):
        with pytest.raises(RuntimeError, match="checkpoint"):
            scratch.scratch_root(Session(spark__master=master, spark__sql__warehouse__dir="/w"))


def test_a_run_deletes_what_it_saved_and_nothing_else(spark, tmp_path):
    kept = scratch.saved(spark.range(4), "kept")
    with scratch.scratch_run(spark) as path:
        inside = scratch.saved(kept, "inside")
        assert path in inside.inputFiles()[0] and inside.count() == 4
        with scratch.scratch_run(spark) as nested:
            assert nested.startswith(path)
        folder = Path(path.removeprefix("file:"))
        assert folder.exists()
    assert not folder.exists() and kept.count() == 4
    with pytest.raises(ValueError, match="scratch"):
        scratch.discard(spark, str(tmp_path))
    assert tmp_path.exists()
