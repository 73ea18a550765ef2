"""All queries of the relational, raster, text and archive families, with their SQL counterparts."""

from __future__ import annotations

from . import archive, catalogue, features, raster, relational, text

QUERIES = {**relational.Q, **raster.Q, **text.Q, **archive.Q, **features.Q, **catalogue.Q}
ORACLES = {**relational.O, **raster.O, **text.O, **archive.O, **features.O, **catalogue.O}
