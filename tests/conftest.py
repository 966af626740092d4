import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cloakline.keys import Keyring  # noqa: E402
from cloakline.plans.registered import KR  # noqa: E402
from cloakline.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def kr() -> Keyring:
    return KR


@pytest.fixture(scope="session")
def other_kr() -> Keyring:
    return Keyring.from_secret(b"another secret of enough length!")
