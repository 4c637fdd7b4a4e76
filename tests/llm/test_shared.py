from types import SimpleNamespace

import pytest

from marlstone.llm import _shared


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master))
    with pytest.raises(RuntimeError):
        _shared.shared_dir(session)
