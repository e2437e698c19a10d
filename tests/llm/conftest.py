from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(scope="session")
def text_spark(spark):
    from slotflow.llm.common import prepare

    return prepare(spark)
