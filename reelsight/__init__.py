"""reelsight: recommendation-data analytics as Spark DataFrame operators.

Every public operator takes DataFrames (plus plain parameters) and returns a
DataFrame built from Spark SQL expressions, so Catalyst can prune, push down
and plan the whole pipeline.  See README.md for the operator map.
"""

from reelsight.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
