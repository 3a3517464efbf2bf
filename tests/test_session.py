import pyarrow as pa
import pytest

from layerkit.session import few_rows, new_path, shared_folder


class Session:
    """Stands in for sessions that differ in master and in what is configured."""

    def __init__(self, master, conf=None, context_dir=None):
        self.master, self.named, self.context_dir = master, conf, context_dir
        self.conf = self.sparkContext = self

    def get(self, key, default):
        return self.named if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.context_dir


def test_shared_folder_is_the_one_configured():
    assert shared_folder(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_folder(Session("yarn", None, "s3a://bucket/dir")) == "s3a://bucket/dir"


def test_a_folder_is_required_in_every_mode():
    for master in ("local[4]", "yarn"):
        with pytest.raises(RuntimeError):
            shared_folder(Session(master))


def test_workers_import_the_package_wherever_they_start(spark):
    def names(batches):
        import layerkit.session as found

        for batch in batches:
            named = pa.array([found.__name__] * len(batch), pa.string())
            yield pa.RecordBatch.from_arrays([named], names=["name"])

    assert spark.range(3).mapInArrow(names, "name string").first()[0] == "layerkit.session"


def test_new_paths_differ(spark):
    assert new_path(spark, "x") != new_path(spark, "x")


def test_few_rows(spark):
    assert [tuple(r) for r in few_rows(spark, [(1, None), (2, "b")], "a bigint, b string").collect()] == [(1, None), (2, "b")]
    assert few_rows(spark, [], "a bigint, b string").count() == 0
