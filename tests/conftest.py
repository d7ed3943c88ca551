from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from meterflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, app="meterflow-tests")


@pytest.fixture(scope="session")
def trained(spark, tmp_path_factory):
    """The whole job on the seeded readings, from a file to saved artifacts."""
    from meterflow import run_training

    from .fixtures import minute_readings

    folder = tmp_path_factory.mktemp("job")
    source = f"{folder}/readings"
    minute_readings(spark).write.option("sep", ";").option("header", True).csv(source)
    result = run_training(
        spark, source, " FAST ", models_path=f"{folder}/models", reports_path=f"{folder}/reports"
    )
    return result, folder
