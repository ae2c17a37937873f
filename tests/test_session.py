"""The shared checkpoint folder and tables written to it."""

import pytest

from silverline.session import checkpoint_dir, path_exists, stored


def test_stored_tables_live_in_the_shared_folder(spark):
    folder = checkpoint_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    df = stored(spark.range(10).withColumnRenamed("id", "k"), "numbers")
    assert df.count() == 10 and all(f.startswith("file:") and "/numbers-" in f for f in df.inputFiles())
    assert stored(df.limit(0), "none").count() == 0  # an empty table keeps its schema


def test_path_exists(spark, tmp_path):
    assert path_exists(spark, str(tmp_path)) and not path_exists(spark, str(tmp_path / "none"))


def test_no_local_folder_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())
