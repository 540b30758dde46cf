from creditloom.operators import grouped, relational, spec

__all__ = ["grouped", "relational", "spec"]
