"""voltgrid — charging-network analytics as lazy Spark DataFrame operators.

Every public operator takes DataFrames (or a ``Tables`` bundle) and returns a
lazy DataFrame; nothing is collected to the driver. See README.md for the map
from operator ids (S01, V07, ...) to modules.
"""

from voltgrid.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
