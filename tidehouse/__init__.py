"""Tidehouse: a layered real-time warehouse expressed as Spark DataFrame operators.

Layers: raw topics -> dimension tables -> detail tables -> windowed summaries. Every operator is a function from
DataFrame to DataFrame; the batch and the streaming form share one entry point wherever Spark allows it.
"""

from tidehouse import functions, operators, plans, sinks, sources, streaming  # noqa: F401

__version__ = "0.1.0"
