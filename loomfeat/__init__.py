"""loomfeat: relational feature engineering on Spark.

Turns a star schema (entity table, loan tables, monthly/instalment histories)
into one wide feature row per entity, and scores it. Everything is expressed
as DataFrame in -> DataFrame out, with column names as parameters, so that
Catalyst plans it and Spark partitions and shuffles it.
"""

from loomfeat.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
