"""Column-level building blocks: report periods, predicates and scalar expressions."""
