"""Plan-level building blocks: skew-safe joins, stage materialisation,
the query registry and its SQL oracle."""
