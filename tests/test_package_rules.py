"""The library never pulls rows to the driver."""

import pathlib
import re

PKG = pathlib.Path(__file__).resolve().parent.parent / "sensorlake"


def test_no_collect_in_library():
    bad = []
    for p in PKG.rglob("*.py"):
        for n, line in enumerate(p.read_text().splitlines(), 1):
            if re.search(r"\.(collect|toPandas|toLocalIterator)\(\)", line) or "localCheckpoint" in line:
                bad.append(f"{p.name}:{n}: {line.strip()}")
    assert not bad, bad
