from __future__ import annotations

import json
import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shoptide.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "shoptide-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="shoptide-tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def rows(df, *columns):
    """The rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


class Topics:
    """Topic files a test appends to, one file per call, in the layout the file sink writes."""

    def __init__(self, folder: str):
        self.folder = Path(folder)
        self.files = 0

    def send(self, topic: str, records: list[dict], at: str = "2024-01-17T00:00:00.000Z") -> None:
        target = self.folder / f"topic={topic}"
        target.mkdir(parents=True, exist_ok=True)
        lines = []
        for offset, record in enumerate(records):
            record = dict(record)
            arrival = record.pop("_at", at)
            value = record.pop("_raw", None) or json.dumps(record, ensure_ascii=False)
            number = self.files * 1000 + offset
            lines.append(json.dumps({"value": value, "offset": number, "timestamp": arrival}, ensure_ascii=False))
        self.files += 1
        hidden = target / f"_tmp-{self.files}"
        hidden.write_text("\n".join(lines) + "\n")
        # Streams take files by modification time, which two quick calls may share.
        os.utime(hidden, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        hidden.rename(target / f"part-{self.files:04d}.json")


@pytest.fixture
def topics(tmp_path):
    return Topics(str(tmp_path / "topics"))
