import os

import pytest

from playlake.session import checkpoint_root, clear_scratch, scratch_mark, scratch_path


def test_scratch_lies_in_the_named_folder_and_is_cleared(spark):
    old, mark = scratch_path(spark, "t_old"), scratch_mark()
    spark.range(3).write.parquet(old)
    paths = [scratch_path(spark, "t_new") for _ in range(3)]
    for path in paths[:2]:
        spark.range(3).write.parquet(path)
    assert all(p.startswith(spark.conf.get("spark.checkpoint.dir")) for p in [old, *paths])
    clear_scratch(spark, mark, keep=(paths[1],))
    there = [os.path.exists(p.removeprefix("file:")) for p in [old, *paths]]
    assert there == [True, False, True, False]


def test_without_a_named_folder_scratch_lies_beside_the_tables(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "hdfs://shared/warehouse/"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    assert checkpoint_root(Session()) == "hdfs://shared/warehouse/_scratch"


def test_runs_in_other_threads_keep_their_scratch(spark):
    from concurrent.futures import ThreadPoolExecutor

    from playlake.session import clear_scratch, scratch_mark

    def other():
        path = scratch_path(spark, "t_other")
        spark.range(3).write.parquet(path)
        return path

    mark, mine = scratch_mark(), scratch_path(spark, "t_mine")
    spark.range(2).write.parquet(mine)
    with ThreadPoolExecutor(1) as pool:
        theirs = pool.submit(other).result()
    clear_scratch(spark, mark)
    assert spark.read.parquet(theirs).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(mine)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        get = staticmethod(lambda key, default=None: "file:/here/spark-warehouse" if "warehouse" in key else default)

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://somewhere:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Cluster())
