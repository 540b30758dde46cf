from creditloom.sources import sinks, snapshots, tables

__all__ = ["sinks", "snapshots", "tables"]
