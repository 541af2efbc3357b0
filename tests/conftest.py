import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def states(spark):
    """Four operating points with their failure label."""
    rows = [
        ("a", "L", 298.1, 308.6, 1551, 42.8, 0, 0),
        ("b", "M", 300.4, 310.2, 1408, 46.3, 85, 0),
        ("c", "H", 302.7, 312.1, 1498, 49.4, 198, 1),
        ("d", "L", 299.0, 309.5, 2861, 4.6, 12, 0),
    ]
    return spark.createDataFrame(
        rows,
        "state_id string, type string, air_temperature_k double, process_temperature_k double,"
        " rotational_speed_rpm int, torque_nm double, tool_wear_min int, machine_failure int",
    )
