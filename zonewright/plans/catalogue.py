"""Every query of the library by name, and the SQL for it."""

from __future__ import annotations

from ..session import tidy
from . import problems, reference

_MODULES = (problems, reference)


def queries() -> dict:
    return {k: tidy(q) for m in _MODULES for k, q in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in _MODULES for k, q in m.oracle_sql().items()}
