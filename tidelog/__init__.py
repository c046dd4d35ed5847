"""Tidelog: Spark pipelines over landed social-network events.

Everything here is ``DataFrame -> DataFrame`` (or ``Column -> Column``); the
caller owns the session.  See README.md for the map of the package.
"""

from tidelog.session import builder, configure, shared_dir, stage, workspace

__all__ = ["builder", "configure", "shared_dir", "stage", "workspace"]
