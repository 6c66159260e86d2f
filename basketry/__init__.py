"""basketry: retail sales and recommendation analytics on Spark DataFrames.

Batch and Structured Streaming forms of two jobs:

* sales by category: sales joined to a product dimension, quantity summed per
  category per tumbling window (``basketry.operators.sales``);
* recommendations: up to k in-stock products of the clicked categories per
  user, previously bought first, then by rating (``basketry.operators.recommend``).

Everything is expressed with the public DataFrame API so that Catalyst and AQE
plan it; no Python code runs per row.
"""

from basketry.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
