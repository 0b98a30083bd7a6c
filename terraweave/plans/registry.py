"""All queries of the land model by name, with their SQL."""

from terraweave.plans import audit, cells, chain, composites, relations, scores, vectors

QUERIES = cells.QUERIES | scores.QUERIES | relations.QUERIES | chain.QUERIES | audit.QUERIES | vectors.QUERIES | composites.QUERIES
ORACLES = cells.ORACLES | scores.ORACLES | relations.ORACLES | chain.ORACLES | audit.ORACLES | vectors.ORACLES | composites.ORACLES
