"""tidemark: point-in-time analytics and corpus preparation on PySpark."""

from tidemark.session import build_session, cut

__all__ = ["build_session", "cut"]
