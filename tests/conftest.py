import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import cloudpickle

from postlume.session import build_session
from tests import clients

cloudpickle.register_pickle_by_value(clients)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8",
                            spark__ui__enabled="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    import __spark_entry__  # noqa: F401  (registers the package for the workers)
    yield session
    session.stop()


@pytest.fixture
def plan():
    def text(df):
        return df.sparkSession._jvm.PythonSQLUtils.explainString(
            df._jdf.queryExecution(), "formatted")
    return text
