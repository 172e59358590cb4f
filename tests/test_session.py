import pytest

from paperloom.session import work_folder


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("__", "."): v for k, v in conf.items()})


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_one_machine_may_use_its_warehouse(master):
    spark = Session(spark__master=master, spark__sql__warehouse__dir="file:/w/")
    assert work_folder(spark, "x").startswith("file:/w/paperloom/x-")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1000]"])
def test_a_cluster_needs_a_shared_folder(master):
    own = {"spark__master": master, "spark__sql__warehouse__dir": "file:/w"}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(Session(**own), "x")
    assert work_folder(Session(**own, spark__checkpoint__dir="file:/shared/"), "x").startswith("file:/shared/paperloom/x-")
    assert work_folder(Session(spark__master=master, spark__sql__warehouse__dir="s3a://b/w"), "x").startswith("s3a://b/w/")
