"""tidemark — market-data analytics as Spark DataFrame operators.

Every operator is a DataFrame -> DataFrame function; Catalyst plans and
executes.  Per-series work (anything ordered by ``open_time`` inside a
``(exchange, symbol, interval)`` key) goes through ``operators.series``,
which splits each key into fixed-size blocks with halo rows so that a hot
key never lands in a single task.
"""

from tidemark.schemas import KEY  # noqa: F401

__version__ = "0.1.0"
