import tempfile

import pytest

from docquarry.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Plain local runs: the shared folder of the tests is a fresh temporary one.
    return local_session(4, "tests", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tests-")})


@pytest.fixture(scope="session")
def sf():
    return SF
