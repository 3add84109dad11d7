"""Column-level functions: text cleaning and token helpers (all built-in
Spark expressions, so they stay inside whole-stage codegen)."""
