"""granary: a PySpark engine that turns raw question logs, scanned books and web pages into clean corpora."""

from granary.session import local_session, materialize, shared_dir

__all__ = ["local_session", "materialize", "shared_dir"]
