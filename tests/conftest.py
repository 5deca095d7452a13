from __future__ import annotations

import pytest

from gridmargin.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "gridmargin-tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def clean_catalog(request):
    yield
    if "spark" in request.fixturenames:
        session = request.getfixturevalue("spark")
        session.catalog.clearCache()
        for table in session.catalog.listTables():
            if table.isTemporary:
                session.catalog.dropTempView(table.name)
