from __future__ import annotations

from types import SimpleNamespace

import pytest

from voidage.llm.common import shared_folder


def session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: conf.get(name.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master, applicationId="app"),
    )


def test_the_folder_that_the_cluster_names():
    assert shared_folder(session("yarn", spark_checkpoint_dir="hdfs://h/c/")).startswith("hdfs://h/c/app/")


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_one_machine_may_use_its_own(master):
    assert shared_folder(session(master)).startswith("file:/tmp/checkpoints/app/")


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://h"])
def test_a_cluster_must_name_one(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(master))
