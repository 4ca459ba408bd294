"""lakemarts: a Spark-native retail-order lakehouse.

Raw CSV files become all-string bronze tables, contract-driven cleansing
produces typed and deduplicated silver tables, a recorded data-quality gate
stops the run on a critical failure, and a star schema (four dimensions, two
facts) feeds four marts plus the queries behind a dashboard.

Every stage is a DataFrame/SQL plan; nothing row-level runs in Python.
"""

from lakemarts.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
