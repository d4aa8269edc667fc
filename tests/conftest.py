from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from trendloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests",
        8,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def day_files(tmp_path):
    """Write objects as ``{kind}/{day}.json`` array files and return the kind's folder."""

    def write(kind: str, days: dict[str, list[dict]]) -> str:
        folder = tmp_path / kind
        folder.mkdir(exist_ok=True)
        for day, objects in days.items():
            (folder / f"{day}.json").write_text(json.dumps(objects, ensure_ascii=False), encoding="utf-8")
        return str(folder)

    return write
