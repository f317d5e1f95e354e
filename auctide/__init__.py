"""auctide: closing-auction snapshot analytics on Spark.

Every public function takes and returns DataFrames so pipelines compose with
``df.transform``. Nothing is collected to the driver except tiny parameter
tables (fold layouts, combination lists) whose size depends on arguments only.
"""

from auctide.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
