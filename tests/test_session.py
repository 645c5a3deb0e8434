"""Where shared files go."""

from types import SimpleNamespace

import pytest

from strata.session import new_folder, shared_folder


def session(**conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)))


def test_the_folder_the_cluster_names_is_used():
    named = session(**{"spark.checkpoint.dir": "hdfs://shared/x/", "spark.master": "yarn"})
    assert shared_folder(named) == "hdfs://shared/x"
    assert new_folder(named, "t").startswith("hdfs://shared/x/t-")
    assert new_folder(named, "t") != new_folder(named, "t")


def test_a_local_session_gets_its_own_once():
    local = session(**{"spark.master": "local[4]"})
    assert shared_folder(local) == shared_folder(local)


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(**{"spark.master": "yarn"}))
