import json
import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from slotline.session import build_session  # noqa: E402
from slotline.sources.claims import CLAIM_TABLE, PAYMENT_TABLE  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "slotline-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_claims(spark):
    """Claim table from ``{id: document}``; a document may also be JSON text."""

    def make(documents):
        rows = [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in documents.items()]
        return spark.createDataFrame(rows, CLAIM_TABLE)

    return make


@pytest.fixture
def make_payments(spark):
    """Payment table from ``(claim id, ISO time or None, document)`` rows."""

    def make(*rows):
        data = [(i, at and datetime.fromisoformat(at), json.dumps(d)) for i, at, d in rows]
        return spark.createDataFrame(data, PAYMENT_TABLE)

    return make
