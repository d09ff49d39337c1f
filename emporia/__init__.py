"""emporia — an e-commerce star-schema warehouse built on Spark DataFrames.

Layers (mirroring the daily batch flow):

* ``sources``   — raw CSV ingest, staged/extracted tables, the testdata adapter
* ``functions`` — typed casts, date helpers, safe arithmetic (all JVM built-ins)
* ``operators`` — insert-only merge, constraint checks, day slices, table layout
* ``plans``     — the four marts and the warehouse jobs (ingest → stage → merge)
* ``streaming`` — the daily increment as an ``availableNow`` file stream
"""

from emporia.session import build_session, work_dir, fresh_dir  # noqa: F401

__all__ = ["build_session", "work_dir", "fresh_dir"]
