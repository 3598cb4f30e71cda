"""Worked queries over the test tables, each beside the SQL it must agree with."""

from loomwork.catalog import (  # noqa: F401  (importing fills the registry)
    cleansing,
    columns,
    files,
    filters,
    heavy,
    joins,
    jobs,
    metrics,
    scalars,
    sets,
    streams,
    tables,
    text,
    windows,
)
from loomwork.catalog.registry import REGISTRY  # noqa: F401
