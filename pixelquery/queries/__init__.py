"""Named queries over the star-schema tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from pixelquery.queries import (
    classes,
    learning,
    regions,
    resampling,
    scenes,
    spectral,
    storage,
    surface,
    training,
)

_MODULES = (
    spectral,
    surface,
    classes,
    training,
    scenes,
    resampling,
    learning,
    storage,
    regions,
)

QUERIES = {name: q for module in _MODULES for name, q in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
