"""Names of output schemas, kept apart per environment."""

from __future__ import annotations

PRODUCTION = "prod"


def schema_name(environment: str, base: str, custom: str | None = None) -> str:
    """Production uses the layer's own name; elsewhere the base goes before it.

    >>> schema_name("prod", "analytics", "marts")
    'marts'
    >>> schema_name("dev", "sam", "marts")
    'sam_marts'
    """
    layer = (custom or "").strip()
    if not layer:
        return base
    return layer if environment == PRODUCTION else f"{base}_{layer}"
