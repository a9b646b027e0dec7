"""Registered queries (DataFrame plans) and their SQL oracle text.

Importing this package imports every ``q_*`` module, which fill
``registry.QUERIES`` / ``registry.ORACLE``.
"""

from tablekit.plans import registry  # noqa: F401
from tablekit.plans import (  # noqa: F401
    q_functions,
    q_ml,
    q_relational,
    q_skew,
    q_sources,
    q_streaming,
    q_tables,
)

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
