"""Where intermediate tables go on a cluster."""

from types import SimpleNamespace

import pytest

from oreflow.session import shared_base


class Conf(dict):
    def get(self, key, *default):
        return dict.get(self, key, *default) if default else self[key]


def on_cluster(spark, **conf):
    """The session as code on another master sees it."""
    return SimpleNamespace(
        conf=Conf({f"spark.{k.replace('_', '.')}": v for k, v in conf.items()}),
        sparkContext=SimpleNamespace(master=conf.pop("master", "spark://host:7077")),
        _jvm=spark._jvm,
        _jsc=spark._jsc,
    )


@pytest.mark.parametrize("folder", ["/shared/kept", "/shared/kept/", "file:/shared/kept", "file:///shared/kept"])
def test_a_folder_without_a_scheme_lies_in_the_default_file_system(spark, folder):
    session = on_cluster(spark, checkpoint_dir=folder)
    assert shared_base(session).replace("///", "/") == "file:/shared/kept"


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,3000]"])
def test_without_a_folder_the_warehouse_is_shared(spark, master):
    session = on_cluster(spark, master=master, sql_warehouse_dir="/shared/tables")
    assert shared_base(session).replace("///", "/") == "file:/shared/tables"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_tasks_in_the_driver_may_use_a_plain_folder(spark, master):
    assert shared_base(on_cluster(spark, master=master, checkpoint_dir="/shared/kept/")) == "/shared/kept"
