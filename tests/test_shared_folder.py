"""The folder of stage tables in cluster sessions, whose machines may mount it."""

from types import SimpleNamespace

import pytest

from pairsift import stages
from tests.test_pipeline import FakeSession


@pytest.fixture
def machines(monkeypatch):
    """Paths are in the file systems that they name; some of them are mounted everywhere."""
    scheme = lambda spark, path: (SimpleNamespace(getUri=lambda: SimpleNamespace(getScheme=lambda: path.split(":")[0])), path)
    monkeypatch.setattr(stages, "file_system", scheme)
    monkeypatch.setattr(stages, "mounted", lambda spark, folder: folder.startswith(("file:/mnt", "file:/warehouse")))


def test_standalone_cluster_with_a_mounted_folder(machines):
    for master in ("spark://host:7077", "k8s://host"):
        assert stages.shared_folder(FakeSession(master, "file:/mnt/x")) == "file:/mnt/x"
        assert stages.shared_folder(FakeSession(master, None, "file:/mnt/y")) == "file:/mnt/y"
        assert stages.shared_folder(FakeSession(master)) == "file:/warehouse/_stages"
        with pytest.raises(ValueError, match="single machine"):
            stages.shared_folder(FakeSession(master, "file:/tmp/x"))


def test_folder_is_tried(spark, tmp_path, monkeypatch):
    folder = tmp_path.as_uri()
    assert not stages.mounted(spark, folder)  # of other clusters: not tried
    monkeypatch.setattr(stages, "MOUNTING", ("local",))
    monkeypatch.setattr(stages, "TRIED", {})
    assert stages.mounted(spark, folder)
    assert not list(tmp_path.iterdir())
    # The driver does not find what tasks have written.
    empty = spark.range(0)
    lost = SimpleNamespace(
        sparkContext=spark.sparkContext, range=spark.range, _jvm=spark._jvm, _jsparkSession=spark._jsparkSession,
        read=SimpleNamespace(schema=lambda fields: SimpleNamespace(parquet=lambda path: empty)),
    )
    assert stages.mounted(lost, folder)  # known by now
    assert not stages.mounted(lost, f"{folder}/other")
