from creditloom.streaming import submissions

__all__ = ["submissions"]
