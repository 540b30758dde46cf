from creditloom.functions import aggregates, scalar, vocabulary

__all__ = ["aggregates", "scalar", "vocabulary"]
