"""Column-level builders: row expressions (exprs) and guarded aggregates (aggfns)."""
