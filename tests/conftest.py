import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from stratum.session import local_session
    s = local_session("*", 8, checkpoint_dir=str(tmp_path_factory.mktemp("checkpoint")))
    yield s
    s.stop()


def rows(df, order=None):
    cols = df.columns
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out
