"""gatewise: visitor, path and event analytics as Spark DataFrame jobs.

Sub-packages
- ``functions``: column expressions shared by the jobs (business day, bands, bins).
- ``sources``: readers, the slice-replacing writer, string ingest and the
  adapter that maps the shared test tables onto the capture schema.
- ``operators``: the jobs themselves (footfall, paths, events, misc).
- ``plans``: job composition in build order plus the DuckDB twin queries.
- ``streaming``: JSON record stream into a table.
"""

from gatewise.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
