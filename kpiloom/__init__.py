"""kpiloom: certified KPI tables built as Spark DataFrame operators.

Layers: sources (raw tables) -> operators.staging -> operators.identity ->
operators.certified -> operators.mart, gated by operators.quality and
operators.governance, served by operators.serving. plans/ composes them.
"""

__version__ = "0.1.0"
