"""What several test modules use; a module of its own name, as every test folder has a conftest."""

from __future__ import annotations


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
