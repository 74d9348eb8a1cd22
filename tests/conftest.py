import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orrery.session import local_session  # noqa: E402
from orrery.sources.generator import generate_orders  # noqa: E402
from orrery.sources.orders import write_orders  # noqa: E402
from orrery.workspace import new_folder  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, memory="6g")


@pytest.fixture
def folder(spark):
    return lambda label="test": new_folder(spark, label)


@pytest.fixture(scope="session")
def orders(spark):
    """About 1,200 generated order lines, stored in several files."""
    rows = generate_orders(spark, orders=300, customers=40, products=30, seed=3)
    return write_orders(rows, new_folder(spark, "test-orders"), highest_id=rows.count())


@pytest.fixture(scope="session")
def orders_path(orders):
    return orders.inputFiles()[0].rsplit("/", 1)[0]
