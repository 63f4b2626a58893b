import time

import pytest

from crawlweave import session


class _Conf:
    def __init__(self, value=None):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getConf(self):
        return _Conf()

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, conf=None, folder=None):
        self.conf, self.sparkContext = _Conf(conf), _Context(master, folder)


def test_folder_is_read_from_the_session():
    assert session.shared_folder(_Session("yarn", conf="hdfs:///shared")) == "hdfs:///shared"
    assert session.shared_folder(_Session("yarn", folder="s3a://b/c")) == "s3a://b/c"


def test_local_session_gets_its_own_and_a_cluster_must_name_one():
    assert session.shared_folder(_Session("local[2]"))
    with pytest.raises(ValueError):
        session.shared_folder(_Session("yarn"))


def test_staged_tables_are_new_each_time(spark):
    df = spark.range(3)
    first, second = session.stage(df, "t"), session.stage(df, "t")
    assert first.inputFiles() != second.inputFiles() and first.count() == second.count() == 3


def test_stage_frees_the_shuffle_files_of_its_write(spark):
    conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(conf, None)
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()) if f.getName().startswith("shuffle")}
    old = files()
    table = session.stage(spark.range(1000).repartition(3, "id"), "freed", free=True)
    for _ in range(50):
        if files() <= old:
            break
        time.sleep(0.1)
    assert files() <= old and table.count() == 1000
    assert spark.conf.get(conf, None) == before
