"""What a run over many statements leaves in the driver."""

import pytest

from aisle.plans import runs
from aisle.plans.runs import BROADCAST, FILE_BROADCAST, MEASURED_BROADCAST, measured_broadcasts, run_power
from aisle.streaming import throughput


def _watched(spark, monkeypatch, module):
    seen = []
    real = runs.observed_rows

    def observed(df):
        seen.append(("run", spark.conf.get(BROADCAST), spark.conf.get(MEASURED_BROADCAST)))
        return real(df)
    monkeypatch.setattr(module, "observed_rows", observed)
    monkeypatch.setattr(module, "release", lambda s: seen.append(("release",)))
    return seen


def _run(spark, sf_dir, module):
    if module is runs:
        return run_power(spark, sf_dir, num="96,7").collect()
    return throughput.run_throughput(spark, sf_dir, streams=1, templates=[96, 7]).collect()


@pytest.mark.parametrize("module", [runs, throughput])
def test_a_run_broadcasts_by_measured_size_and_releases_each_statement(spark, monkeypatch, module):
    given = spark.conf.get(BROADCAST)
    seen = _watched(spark, monkeypatch, module)
    rows = _run(spark, "/root/testdata/sf0.001", module)
    assert len(rows) == 2 and [x[0] for x in seen] == ["run", "release"] * 2
    assert {x[1:] for x in seen if x[0] == "run"} == {(str(FILE_BROADCAST), given)}
    assert spark.conf.get(BROADCAST) == given and spark.conf.get(MEASURED_BROADCAST, None) is None


@pytest.mark.parametrize("own", ["-1", "100k", "262144"])
def test_a_smaller_threshold_of_the_session_stays(spark, own):
    given = spark.conf.get(BROADCAST)
    spark.conf.set(BROADCAST, own)
    try:
        with measured_broadcasts(spark):
            assert spark.conf.get(BROADCAST) == own and spark.conf.get(MEASURED_BROADCAST, None) is None
        assert spark.conf.get(BROADCAST) == own
    finally:
        spark.conf.set(BROADCAST, given)


def test_narrow_columns_of_a_long_table_are_not_broadcast_by_the_size_of_their_file(spark, tmpdir_path):
    """Half a million keys beside repeated text: 2 MB of file by the guess, 8 MB and more of rows."""
    spark.range(500_000).selectExpr("id", *[f"'text' AS t{i}" for i in range(12)]).write.parquet(f"{tmpdir_path}/long")
    spark.range(10).write.parquet(f"{tmpdir_path}/fact")

    def strategy():
        long = spark.read.parquet(f"{tmpdir_path}/long").selectExpr("id", "t0")
        fact = spark.read.parquet(f"{tmpdir_path}/fact")
        plan = fact.join(long, "id", "left")._jdf.queryExecution().sparkPlan().toString()
        return "BroadcastHashJoin" in plan
    assert strategy()
    with measured_broadcasts(spark):
        assert not strategy()
