"""A profile that follows the files of a folder equals a full one and reads what is new."""

import os

import pytest

from tierflow.operators.profile import profile_columns
from tierflow.operators.profile_state import GROUP, stored_profile, update_profile
from tierflow.sources.snapshots import read_snapshot

SHAPE = "k int, v string, x double, d decimal(5,2)"


def part(spark, folder, name, data):
    """One Parquet file with the given name."""
    spark.createDataFrame(data, SHAPE).coalesce(1).write.mode("overwrite").parquet(f"{folder}-{name}")
    made = next(f for f in os.listdir(f"{folder}-{name}") if f.endswith(".parquet"))
    os.makedirs(folder, exist_ok=True)
    os.replace(f"{folder}-{name}/{made}", f"{folder}/{name}.parquet")


def full(spark, folder, rows):
    return rows(profile_columns(spark.read.parquet(folder), "t"))


def names(read):
    return [os.path.basename(path) for path in read]


@pytest.fixture
def places(spark, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    part(spark, folder, "a", [(1, "x", 1.5, None), (2, None, -2.0, None), (10, "x", None, None)])
    part(spark, folder, "b", [(9, "y", 10.5, None)])
    return folder, state


def test_added_files_are_read_alone(spark, places, rows):
    folder, state = places
    assert names(update_profile(spark, folder, state)) == ["a.parquet", "b.parquet"]
    assert rows(stored_profile(spark, state, "t")) == full(spark, folder, rows)
    part(spark, folder, "c", [(1, "y", 9.5, None), (None, "y", 9.5, None)])
    # The files that were counted before cannot be read any more: same name, time and size, other bytes.
    for name in ("a", "b"):
        path = f"{folder}/{name}.parquet"
        seen, size = os.stat(path), os.path.getsize(path)
        want = open(path, "rb").read()
        with open(path, "wb") as file:
            file.write(b"?" * size)
        os.utime(path, ns=(seen.st_atime_ns, seen.st_mtime_ns))
        places = (*places, (path, want, seen))
    assert names(update_profile(spark, folder, state)) == ["c.parquet"]
    got = rows(stored_profile(spark, state, "t"))
    for path, want, seen in places[2:]:
        with open(path, "wb") as file:
            file.write(want)
        os.utime(path, ns=(seen.st_atime_ns, seen.st_mtime_ns))
        os.path.exists(f"{folder}/.{os.path.basename(path)}.crc") and os.remove(f"{folder}/.{os.path.basename(path)}.crc")
    assert got == full(spark, folder, rows)
    assert update_profile(spark, folder, state) == []


def test_changed_and_removed_files(spark, places, rows):
    folder, state = places
    update_profile(spark, folder, state)
    part(spark, folder, "c", [(5, "z", 0.0, None)])
    update_profile(spark, folder, state)
    os.utime(f"{folder}/c.parquet", (1, 1))  # touched: only its group is counted again
    assert names(update_profile(spark, folder, state)) == ["c.parquet"]
    os.remove(f"{folder}/a.parquet")  # `b` was counted together with it
    assert names(update_profile(spark, folder, state)) == ["b.parquet"]
    assert rows(stored_profile(spark, state, "t")) == full(spark, folder, rows)
    os.remove(f"{folder}/b.parquet")
    assert update_profile(spark, folder, state) == []
    assert rows(stored_profile(spark, state, "t")) == full(spark, folder, rows)
    assert read_snapshot(spark, f"{state}/counts").select(GROUP).distinct().count() == 1


def test_an_update_that_stops_between_its_writes_counts_nothing_twice(spark, places, rows, monkeypatch):
    folder, state = places
    update_profile(spark, folder, state)
    before = rows(stored_profile(spark, state, "t"))
    part(spark, folder, "c", [(5, "z", 0.0, None)])

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr("tierflow.operators.profile_state.publish", killed)
        with pytest.raises(KeyboardInterrupt):
            update_profile(spark, folder, state)
    assert rows(stored_profile(spark, state, "t")) == before
    update_profile(spark, folder, state)
    assert rows(stored_profile(spark, state, "t")) == full(spark, folder, rows)
    assert rows(stored_profile(spark, state, "t"))[0][0] == "t"
