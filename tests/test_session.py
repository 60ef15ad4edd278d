import os

from pulseframe import session


def test_scratch_is_deleted(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch", [])
    path = session.scratch_path(spark, "probe")
    spark.range(5).write.parquet(path)
    folder = path.removeprefix("file:")
    assert os.path.exists(folder)
    session.drop_scratch()
    assert not os.path.exists(folder) and session._scratch == []
