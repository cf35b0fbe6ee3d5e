import os

import pytest

from cartlake import session


def test_the_named_folder_is_used(spark, tmp_path, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return str(tmp_path) + "/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert session.shared_folder(Session()) == str(tmp_path)


def test_a_cluster_must_name_a_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_staged_table_is_the_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    staged = session.stage(df, "t")
    assert sorted(staged.collect()) == sorted(df.collect())
    assert session.shared_folder(spark) == session.shared_folder(spark)
    assert staged.inputFiles()[0].startswith("file:" + "//" + session.shared_folder(spark))


def test_staged_tables_go_at_the_end_of_a_job(spark):
    session.remove_staged(spark)
    path = session.write_stage(spark.range(3), "t")
    assert path in session.STAGED[spark.sparkContext.applicationId]
    session.remove_staged(spark)
    assert not os.path.exists(path) and not session.STAGED
    session.remove_staged(spark)
