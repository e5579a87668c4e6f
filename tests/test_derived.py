"""The measured-games table written once under spark.checkpoint.dir."""

import shutil

from gamestats.sources.derived import TABLES_FOLDER
from gamestats.sources.star import games_from_star, games_table

from conftest import SF_SMALL


def _location(df):
    files = df.inputFiles()
    assert files and all(TABLES_FOLDER in f for f in files)
    return {f.rsplit("/", 1)[0] for f in files}


def test_table_equals_view(spark):
    t = games_table(spark, SF_SMALL)
    v = games_from_star(spark, SF_SMALL)
    # Parquet reads every column back as nullable; names and types are kept.
    assert t.dtypes == v.dtypes
    assert t.exceptAll(v).count() == 0 and v.exceptAll(t).count() == 0


def test_table_is_reused_and_follows_its_inputs(spark, tmp_path):
    src = tmp_path / "sf"
    src.mkdir()
    for name in ("orders", "lineitem"):
        shutil.copyfile(f"{SF_SMALL}/{name}.parquet", src / f"{name}.parquet")
    first = games_table(spark, str(src))
    again = games_table(spark, str(src))
    assert _location(first) == _location(again)
    n = first.count()

    # Replace the orders file by a smaller one: a new table must be built.
    orders = spark.read.parquet(str(src / "orders.parquet")).where("o_orderkey % 2 = 0")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders_half"))
    part = [p for p in (tmp_path / "orders_half").iterdir() if p.name.endswith(".parquet")][0]
    shutil.copyfile(part, src / "orders.parquet")
    changed = games_table(spark, str(src))
    assert _location(changed) != _location(first)
    assert changed.count() == spark.read.parquet(str(src / "orders.parquet")).count() < n


def test_table_removed_is_rebuilt(spark, tmp_path):
    from gamestats.sources.derived import _hadoop_path

    src = tmp_path / "sf"
    src.mkdir()
    for name in ("orders", "lineitem"):
        shutil.copyfile(f"{SF_SMALL}/{name}.parquet", src / f"{name}.parquet")
    first = games_table(spark, str(src))
    n = first.count()
    (folder,) = _location(first)
    path, fs = _hadoop_path(spark, folder)
    fs.delete(path, True)                      # the data folder goes; its pointer stays
    again = games_table(spark, str(src))
    (rebuilt,) = _location(again)
    assert rebuilt != folder and rebuilt.rsplit("/", 1)[0] == folder.rsplit("/", 1)[0]
    assert again.count() == n


def test_measured_csv_table_equals_measured_reader(spark, games_csv):
    import os

    from conftest import FIXTURES
    from gamestats.sources.files import measured_games_table

    t = measured_games_table(spark, os.path.join(FIXTURES, "games.csv"))
    assert t.dtypes == games_csv.dtypes
    assert t.exceptAll(games_csv).count() == 0 and games_csv.exceptAll(t).count() == 0


def test_unwritable_folder_falls_back_to_the_view(spark, tmp_path, monkeypatch):
    """If the table cannot be written, the query still runs on the view."""
    import pytest

    from gamestats.sources import derived

    blocked = tmp_path / "blocked"
    blocked.write_text("a file where a folder is needed")
    monkeypatch.setattr(derived, "ensure_checkpoint_dir", lambda s: str(blocked))
    orders = f"{SF_SMALL}/orders.parquet"
    with pytest.warns(RuntimeWarning):
        df = derived.derived_table(spark, "probe", [orders],
                                   lambda: spark.read.parquet(orders), "v1")
    assert df.count() == spark.read.parquet(orders).count()


class _FakeConf:
    def get(self, key, default=None):
        return default


class _FakeContext:
    master = "yarn"

    def getConf(self):
        return _FakeConf()

    def getCheckpointDir(self):
        return None


class _FakeSession:
    sparkContext = _FakeContext()


def test_no_machine_local_folder_on_a_cluster():
    import pytest

    from gamestats.session import NoSharedFolder, ensure_checkpoint_dir

    with pytest.raises(NoSharedFolder):
        ensure_checkpoint_dir(_FakeSession())


def test_cluster_without_shared_folder_reads_the_view(spark, monkeypatch):
    import pytest

    from gamestats.session import NoSharedFolder
    from gamestats.sources import derived

    def no_folder(s):
        raise NoSharedFolder("unset")

    monkeypatch.setattr(derived, "ensure_checkpoint_dir", no_folder)
    orders = f"{SF_SMALL}/orders.parquet"
    with pytest.warns(RuntimeWarning):
        df = derived.derived_table(spark, "probe", [orders],
                                   lambda: spark.read.parquet(orders), "v1")
    assert df.inputFiles() == spark.read.parquet(orders).inputFiles()


def test_glob_inputs_are_fingerprinted(spark, tmp_path):
    from gamestats.sources.derived import input_fingerprint
    from gamestats.sources.files import measured_games_table

    src = tmp_path / "games"
    src.mkdir()
    import os

    from conftest import FIXTURES
    shutil.copyfile(os.path.join(FIXTURES, "games.csv"), src / "a.csv")
    glob = str(src / "*.csv")
    before = input_fingerprint(spark, [glob])
    assert "a.csv" in before
    t = measured_games_table(spark, glob)
    assert t.count() == 7
    shutil.copyfile(os.path.join(FIXTURES, "games.csv"), src / "b.csv")
    assert input_fingerprint(spark, [glob]) != before
    assert measured_games_table(spark, glob).count() == 14


def test_concurrent_builder_keeps_the_first_published_table(spark, tmp_path, monkeypatch):
    """If another builder publishes while we build, ours is dropped and theirs
    is read."""
    from gamestats.sources import derived

    orders = f"{SF_SMALL}/orders.parquet"
    build = lambda: spark.read.parquet(orders)
    monkeypatch.setattr(derived, "ensure_checkpoint_dir", lambda s: str(tmp_path / "ckpt"))
    real_create = derived._create_pointer

    def lose_the_race(fs, pointer, folder):
        # Another builder publishes its own table just before we try to.
        spark.read.parquet(orders).write.parquet(str(tmp_path / "ckpt" / "other"))
        real_create(fs, pointer, "../../other")
        return False

    monkeypatch.setattr(derived, "_create_pointer", lose_the_race)
    df = derived.derived_table(spark, "race", [orders], build, "v1")
    files = df.inputFiles()
    assert files and all("/other/" in f for f in files)
    (table,) = list((tmp_path / "ckpt" / "gamestats-tables").iterdir())
    assert [f.name for f in table.iterdir() if f.name.startswith("data-")] == []


def test_rated_items_table_equals_filtered_view(spark):
    from gamestats.operators.best import rated_items
    from gamestats.sources.star import rated_items_table, ratings_from_events

    t = rated_items_table(spark, SF_SMALL, "purchase")
    v = rated_items(ratings_from_events(spark, SF_SMALL), "purchase")
    assert t.dtypes == v.dtypes
    assert t.exceptAll(v).count() == 0 and v.exceptAll(t).count() == 0
    assert _location(rated_items_table(spark, SF_SMALL, "purchase")) == _location(t)


def test_nested_file_rewritten_with_equal_length_is_seen(spark, tmp_path):
    import os

    from gamestats.sources.derived import input_fingerprint

    nested = tmp_path / "in" / "day=1"
    nested.mkdir(parents=True)
    (nested / "a.csv").write_text("1-0")
    before = input_fingerprint(spark, [str(tmp_path / "in")])
    assert input_fingerprint(spark, [str(tmp_path / "in")]) == before
    (nested / "a.csv").write_text("0-1")
    os.utime(nested / "a.csv", (1, 1))
    assert input_fingerprint(spark, [str(tmp_path / "in")]) != before


def test_error_of_a_build_is_raised_once(spark, tmp_path, monkeypatch):
    import pytest
    from pyspark.sql import functions as F

    from gamestats.sources import derived

    monkeypatch.setattr(derived, "ensure_checkpoint_dir", lambda s: str(tmp_path / "ckpt"))
    builds = []

    def build():
        builds.append(1)
        return spark.range(3).select(F.raise_error(F.lit("bad row")).cast("string").alias("x"))

    with pytest.raises(Exception, match="bad row"):
        derived.derived_table(spark, "failing", [f"{SF_SMALL}/orders.parquet"], build, "v1")
    assert len(builds) == 1


def test_table_without_success_marker_is_reused(spark, tmp_path, monkeypatch):
    from gamestats.sources import derived

    monkeypatch.setattr(derived, "ensure_checkpoint_dir", lambda s: str(tmp_path / "ckpt"))
    orders = f"{SF_SMALL}/orders.parquet"
    build = lambda: spark.read.parquet(orders)
    first = _location(derived.derived_table(spark, "unmarked", [orders], build, "v1"))
    for marker in (tmp_path / "ckpt").rglob("_SUCCESS"):
        marker.unlink()
    derived._readers.clear()
    assert _location(derived.derived_table(spark, "unmarked", [orders], build, "v1")) == first
