from millrace.sources.tables import table

__all__ = ["table"]
