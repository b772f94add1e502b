"""Housing-market loading and analytics as plain Spark DataFrame jobs."""

from toitscope.session import build_session, name_shared_folder, shared_folder

__all__ = ["build_session", "name_shared_folder", "shared_folder"]
