"""Query registry (Spark) and the matching SQL oracles."""
