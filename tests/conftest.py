from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.schema import VISIT_SCHEMA  # noqa: E402
from quayside.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "quayside-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield session
    session.stop()


def ts(text: str | None):
    return datetime.fromisoformat(text) if text else None


DEFAULTS = {
    "visit_id": "v", "container_id": "C1", "size_ft": 40, "container_type": "dry",
    "weight_tons": 10.0, "gate_in_time": ts("2025-01-01 00:00:00"), "gate_out_time": None,
    "movement_type": "import", "yard_block": "A01", "iso_type_code": "42G1",
    "yard_bay": 1, "yard_row": 1, "yard_tier": 1, "vessel_name": "V", "shipping_line": "L",
    "cargo_category": None, "gate_in_mode": "vessel", "gate_out_mode": "truck",
}


@pytest.fixture(scope="session")
def make_visits(spark):
    """Visits from a list of partial rows; everything else takes the defaults."""
    def make(rows: list[dict]):
        full = [{**DEFAULTS, "visit_id": f"v{i:04d}", **row} for i, row in enumerate(rows)]
        return spark.createDataFrame(
            [tuple(r[f.name] for f in VISIT_SCHEMA) for r in full], VISIT_SCHEMA)
    return make
