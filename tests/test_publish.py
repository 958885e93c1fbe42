"""Published runs, and folders that a run leaves behind."""

from pathlib import Path

import pytest

from tidewatch import registry
from tidewatch.plans.pipeline import PUBLISHED, Run
from tidewatch.sources.snapshots import Snapshots
from tidewatch.staging import new_folder, shared_folder

SF_DIR = "/root/testdata/sf0.001"
DASHBOARDS = [n for n in registry.RUN_QUERIES if n.startswith(("dash_", "kpi_", "v_dash", "ring_edges", "mule_members", "display"))]


def staged(spark):
    return {p.name for p in Path(shared_folder(spark).removeprefix("file:")).iterdir()}


@pytest.fixture(scope="module")
def published(spark):
    folder = new_folder(spark, "published")
    before = staged(spark)
    with Run.over_sample(spark, SF_DIR, registry.RAISED_AT) as run:
        run.publish(folder)
        during = staged(spark)
        want = {n: sorted(map(str, registry.flat(registry.RUN_QUERIES[n](run)).collect())) for n in DASHBOARDS}
    assert len(during - before) > 8
    assert staged(spark) - before == {Path(folder).name}, "a closed run leaves nothing but what it published"
    return folder, want


def test_dashboards_over_a_published_folder_detect_nothing(spark, published):
    folder, want = published
    before = staged(spark)
    opened = Run.opened(spark, folder, Run.over_sample(spark, SF_DIR).table)
    for name in DASHBOARDS:
        assert sorted(map(str, registry.flat(registry.RUN_QUERIES[name](opened)).collect())) == want[name], name
    assert opened.folders == [] and staged(spark) == before


def counts(tables):
    return {n: tables[n].count() for n in PUBLISHED}


def test_publishing_again_replaces_at_once(spark, published):
    """A reader that opened before keeps the old run; the next but one takes it away."""
    folder, _ = published
    store = Snapshots(spark, folder)
    old, (first,) = store.read(PUBLISHED), store.versions()
    before = counts(old)
    with Run.over_sample(spark, SF_DIR) as run:
        run.publish(folder)
        assert len(store.versions()) == 2 and store.versions()[1] == first
        assert counts(old) == before == counts(store.read(PUBLISHED))
        run.publish(folder)
    assert first not in store.versions() and not Path(folder.removeprefix("file:"), first).exists()


def numbers(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "n int")


def read(store):
    return {name: sorted(r.n for r in table.collect()) for name, table in store.read(["a", "b"]).items()}


def test_a_publish_that_dies_leaves_the_old_version(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "set"))
    with pytest.raises(FileNotFoundError):
        store.current()
    store.write({"a": numbers(spark, 1), "b": numbers(spark, 2)})
    opened = store.read(["a", "b"])
    broken = numbers(spark, 4).selectExpr("raise_error('lost')", "n")
    with pytest.raises(Exception, match="lost"):
        store.write({"a": numbers(spark, 3), "b": broken})
    assert read(store) == {"a": [1], "b": [2]} and len(store.versions()) == 1
    store.write({"a": numbers(spark, 5), "b": numbers(spark, 6)})
    assert read(store) == {"a": [5], "b": [6]}
    assert [r.n for r in opened["b"].collect()] == [2]


def test_old_versions_are_pruned(spark, tmp_path, monkeypatch):
    folder = tmp_path / "set"
    store = Snapshots(spark, str(folder), keep=1)
    for i in range(3):
        store.write({"a": numbers(spark, i), "b": numbers(spark, i)})
    assert read(store) == {"a": [2], "b": [2]}
    assert [p.name for p in folder.iterdir() if p.name.startswith("version-")] == store.versions()
    left = folder / "version-of-a-writer-that-died"
    left.mkdir()
    store.write({"a": numbers(spark, 7), "b": numbers(spark, 7)})
    assert left.exists(), "it may still be writing"
    monkeypatch.setattr("tidewatch.sources.snapshots.LEFT_AFTER_HOURS", -1)
    store.write({"a": numbers(spark, 8), "b": numbers(spark, 8)})
    assert not left.exists() and read(store) == {"a": [8], "b": [8]}
    with pytest.raises(ValueError):
        Snapshots(spark, str(folder), keep=0)
