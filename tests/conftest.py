import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from avisflow.session import get_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=4, app_name="avisflow-tests")
    shared_dir(s)  # tests may set their own checkpoint folder when the session names none
    yield s
