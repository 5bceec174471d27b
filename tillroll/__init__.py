"""tillroll: retail sales analytics as Spark DataFrame functions.

Every public function takes DataFrames (or a SparkSession and paths) and
returns a lazily planned DataFrame; nothing is collected to the driver except
bounded metadata (row counts, range cut points of at most a few thousand rows).
"""

from tillroll.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
