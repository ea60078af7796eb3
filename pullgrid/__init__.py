"""Pull requests of a code host as Spark tables, SQL views and streams."""

from pullgrid.folders import scratch_dir
from pullgrid.session import create_view, pull_requests, register

__all__ = ["create_view", "pull_requests", "register", "scratch_dir"]
