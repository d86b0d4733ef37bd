"""tagloom: user-tagging jobs as PySpark DataFrame plans."""

from tagloom.session import build_session

__all__ = ["build_session"]
