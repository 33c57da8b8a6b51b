"""Every operator as a query on the test tables, beside the SQL that checks it."""

from __future__ import annotations

from . import clicks, messages, orders, sinks, sources
from .registry import Query

ALL: dict[str, Query] = {}
for _module in (sources, orders, messages, clicks, sinks):
    _repeated = ALL.keys() & _module.registry.queries.keys()
    if _repeated:
        raise ValueError(f"registered twice: {_repeated}")
    ALL.update(_module.registry.queries)
