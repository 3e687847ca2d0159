"""Publishing marts: views recomputed on read, and folders per audience."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame

from tidemark.plans.model import AUDIENCES
from tidemark.session import side_by_side
from tidemark.sources.tables import rebuild


class NotAllowed(PermissionError):
    """A mart was offered to an audience that may not read it."""


def register_views(marts: Mapping[str, DataFrame]) -> None:
    """Views hold the plan, not rows: each read recomputes from the tables below."""
    for name, mart in marts.items():
        mart.createOrReplaceTempView(name)


def publish(
    audience: str,
    marts: Mapping[str, DataFrame],
    root: str,
    allowed: Mapping[str, Sequence[str]] = AUDIENCES,
) -> list[str]:
    """Write marts below the audience's own folder; nothing is written if one is barred."""
    if audience not in allowed:
        raise NotAllowed(f"unknown audience {audience!r}")
    barred = sorted(set(marts) - set(allowed[audience]))
    if barred:
        raise NotAllowed(f"{audience} may not read {', '.join(barred)}")
    side_by_side(partial(rebuild, mart, f"{root}/{audience}/{name}") for name, mart in marts.items())
    return sorted(marts)
