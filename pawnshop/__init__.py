"""pawnshop: Spark-native analytics for recorded two-player board games.

Every operator is a ``DataFrame -> DataFrame`` function that takes its column
names as parameters, so the same code runs on game tables and on ordinary
star-schema tables (see ``pawnshop.plans.adapters``).
"""

from pawnshop.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
