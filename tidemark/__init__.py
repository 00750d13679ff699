"""tidemark: change-data and versioned-table analytics on Spark.

The core object is a *change log* DataFrame (one row per row-level change with
an op code, a key, an event time ``ts_ms`` and a tie-break position ``pos``).
Every operator is a DataFrame -> DataFrame function built from Spark's own
relational operators, so Catalyst plans it and the work runs distributed.
"""

from tidemark.spec import TableSpec, SPECS, EVENTS_SPEC  # noqa: F401
from tidemark.session import local_session, work_dir  # noqa: F401

__all__ = ["TableSpec", "SPECS", "EVENTS_SPEC", "local_session", "work_dir"]
