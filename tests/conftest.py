import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from millrace.plans.ship import ship
    from millrace.session import session

    s = session("local[4]", 4)
    ship(s)
    return s


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
