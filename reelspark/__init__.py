"""reelspark: recommendation analytics as Spark DataFrame operators.

Every public operator is a function ``DataFrame(s) -> DataFrame``; the caller
owns the ``SparkSession``, paths and connection options. Nothing is collected
to the driver except bounded scalars (row counts, a 9-row grid summary).
"""

from reelspark.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
