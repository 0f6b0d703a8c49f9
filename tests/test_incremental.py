import pytest
from conftest import SMALL, as_dicts
from pyspark.sql import functions as F

from contest_analytics.operators import incremental, trends
from contest_analytics.sources import files, standins

KEYS = ["yr", "mo"]


def moments_of(df):
    return trends.moments(df, KEYS, "duration")


@pytest.fixture
def state(spark, tmp_path):
    return incremental.KeptState(spark, f"{tmp_path}/state", incremental.merged_moments(KEYS))


def rounded(df):
    return as_dicts(df.withColumn("squared_dev", F.round("squared_dev", 2)).orderBy(*KEYS), *KEYS)


def test_three_increments_equal_one_run(spark, state):
    matches = standins.matches(spark, SMALL)
    assert state.read() is None and state.version() == 0 and state.parts() == []
    for i in range(3):
        assert state.add(moments_of(matches.where(F.col("match_id") % 3 == i)), f"day {i}")
    assert rounded(state.read()) == rounded(moments_of(matches).select(*state.read().columns))
    assert state.version() == 3 and state.parts() == ["day 0", "day 1", "day 2"]


def test_a_part_counts_once(spark, state):
    part = moments_of(standins.matches(spark, SMALL))
    assert state.add(part, "a") and not state.add(part, "a")
    assert state.version() == 1 and state.read().agg(F.sum("n")).first()[0] == standins.matches(spark, SMALL).count()


def test_a_failed_run_leaves_the_state(spark, state):
    part = moments_of(standins.matches(spark, SMALL))
    state.add(part, "a")
    before = rounded(state.read())
    broken = part.withColumn("n", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        state.add(broken, "b")
    assert state.version() == 1 and rounded(state.read()) == before
    assert state.add(part, "b") and state.parts() == ["a", "b"]


def test_of_two_writers_one_fails(spark, state, monkeypatch):
    part = moments_of(standins.matches(spark, SMALL))
    real = files.write_json

    def late(session, path, value, replace=False):
        monkeypatch.setattr(files, "write_json", real)
        state.add(part, "first")  # another run commits in between
        real(session, path, value, replace)

    monkeypatch.setattr(files, "write_json", late)
    with pytest.raises(FileExistsError):
        state.add(part, "second")
    assert state.parts() == ["first"] and len(files.names(spark, f"{state.folder}/versions")) == 1


def test_tidy_keeps_the_last_versions(spark, state):
    part = moments_of(standins.matches(spark, SMALL).where("mo = 1"))
    for i in range(4):
        state.add(part, str(i))
    state.tidy(keep=2)
    assert len(files.names(spark, f"{state.folder}/versions")) == 2
    assert state.read(3) is not None and state.read(2) is None and state.parts() == ["0", "1", "2", "3"]
    assert state.add(part, "4") and state.version() == 5


def test_counts_add_up(spark, tmp_path, rows):
    state = incremental.KeptState(spark, f"{tmp_path}/s", incremental.merged_sums(["k"]))
    state.add(rows("k int, n bigint", (1, 2), (None, 3)), "a")
    state.add(rows("k int, n bigint", (None, 4), (2, 1)), "b")
    state.add(rows("k int, n bigint"), "empty")
    assert {(r.k, r.n) for r in state.read().collect()} == {(1, 2), (None, 7), (2, 1)}
