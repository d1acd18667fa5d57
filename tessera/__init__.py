"""tessera: reusable Spark DataFrame operators for sales summaries, league
tables built from shot logs, word statistics, regression, clustering and
file streams.

Every operator takes DataFrames (plus column names and parameters) and
returns a DataFrame; nothing is collected to the driver inside an operator.
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
