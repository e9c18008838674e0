from __future__ import annotations

from datetime import datetime, timezone

import pytest

import __spark_entry__ as entry
from martweave.__main__ import main, parse
from martweave.functions.privacy import SaltMissing
from martweave.plans.build import TestsFailed, mart
from martweave.sources.landing import LANDINGS


def test_arguments():
    got = parse(["ingest", "--raw", "r", "--load-id", "1", "--source", "crm.users=p", "--first", "2023-05-01"])
    assert got.source == [(("crm", "users"), "p")]
    assert got.first == datetime(2023, 5, 1, tzinfo=timezone.utc)
    with pytest.raises(SystemExit):
        parse(["ingest", "--raw", "r", "--load-id", "1", "--source", "shop.users=p"])


def test_ingest_then_build(spark, folder, tmp_path, monkeypatch):
    tables = entry.OrderTables(spark, folder)
    sources = []
    for landing in LANDINGS.values():
        place = str(tmp_path / "source" / landing.table)
        tables.read(landing.source, landing.table).write.parquet(place)
        sources += ["--source", f"{landing.source}.{landing.table}={place}"]
    raw, marts = str(tmp_path / "raw"), str(tmp_path / "marts")
    assert main(["ingest", "--raw", raw, "--load-id", "1", "--first", "1990-01-01", *sources]) == 0
    # A table that cannot be read is reported through the exit code.
    assert main(["ingest", "--raw", raw, "--load-id", "2", *sources[:2]]) == 1

    build = ["build", "--raw", raw, "--marts", marts, "--environment", "prod", "--horizon", "1996-01-01"]
    monkeypatch.delenv("PSEUDONYMISATION_SALT", raising=False)
    with pytest.raises(SaltMissing):
        main(build)
    monkeypatch.setenv("PSEUDONYMISATION_SALT", "s")
    with pytest.raises(FileNotFoundError, match="nothing was ever loaded"):
        main([*build[:2], str(tmp_path / "mistyped"), *build[3:]])
    try:
        main(build)
    except TestsFailed as failed:
        pytest.fail(str(failed))
    assert mart(spark, f"{marts}/marts", "fct_orders").read().count() > 1000
