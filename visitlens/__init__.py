"""visitlens — click-stream session analytics on Spark DataFrames.

Rolls a visit log up to sessions, joins user profiles, filters sessions by
task parameters, reports visit/step-length distributions, ranks the top
categories and the top sessions per category, exports the raw actions of
those sessions and draws a repeatable hour-proportional sample of sessions.

Everything is expressed with ``pyspark.sql`` Column expressions so Catalyst
can prune, push down and partially aggregate; no row-wise Python runs on the
hot path and no result passes through the driver.
"""

from visitlens.params import TaskParams

__all__ = ["TaskParams"]
