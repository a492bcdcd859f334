import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from loadlens.session import build_session, shared_dir
    s = build_session("local[4]", shuffle_partitions=4, app_name="loadlens-tests")
    shared_dir(s)
    yield s
    s.stop()


D0_DAY = 19723            # 2024-01-01 as unix date
D0 = D0_DAY * 86400 - 32400   # 00:00 JST of 2024-01-01


def readings(spark, rows, user_type="string"):
    return spark.createDataFrame(
        rows, f"user_id {user_type}, app_type_id string, t long, power double")
