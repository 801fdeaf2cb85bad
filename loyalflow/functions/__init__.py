"""Column-expression helpers (all built-in Spark functions, no UDFs)."""

from . import dates, stats, text  # noqa: F401
