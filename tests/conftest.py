import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from faremill.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", **{
        "spark.master": "local[8]",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        # A zone with daylight saving: nothing may depend on the session's zone.
        "spark.sql.session.timeZone": "America/New_York",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def zone_with_daylight_saving(spark):
    # The command line sets the engine's own zone on the shared session.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
