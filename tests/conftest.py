import json
import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)
# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join([REPO, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from playlake.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    conf = {"spark.checkpoint.dir": f"file:{shared}/checkpoint", "spark.sql.warehouse.dir": f"file:{shared}/warehouse"}
    s = build_session("local[4]", 4, app_name="playlake-tests", extra=conf)
    yield s


@pytest.fixture
def write_jsonl(tmp_path):
    """Write JSON-lines text (optionally gzip) under tmp_path/<rel>; returns the root."""
    import gzip

    def _write(rel: str, records: list, gz: bool = True, raw_lines: list[str] | None = None):
        path = tmp_path / rel
        path.parent.mkdir(parents=True, exist_ok=True)
        lines = raw_lines if raw_lines is not None else [json.dumps(r) for r in records]
        data = ("\n".join(lines) + "\n").encode()
        if gz:
            with gzip.open(str(path), "wb") as fh:
                fh.write(data)
        else:
            path.write_bytes(data)
        return str(tmp_path)

    return _write
