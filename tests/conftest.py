from __future__ import annotations

import pytest

from tests.sessions import local_session


@pytest.fixture(scope="session")
def spark():
    # Tests run many tiny plans once each; compiling them would take most of the time.
    return local_session(**{"spark.sql.codegen.wholeStage": "false", "spark.sql.shuffle.partitions": "4"})


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
