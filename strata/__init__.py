"""strata: layered (bronze -> silver -> gold) batch analytics on Spark DataFrames."""

from .session import get_session, new_scratch_path, scratch_root

__all__ = ["get_session", "new_scratch_path", "scratch_root"]
