"""DataFrame transformations: deduplication, refinement, standings, contracts."""
