"""starloom: a Spark-native medallion pipeline (raw -> bronze -> silver star schema).

Every transformation is a DataFrame -> DataFrame function so Catalyst sees
the whole plan; storage and orchestration helpers live in ``sources``.
"""

from starloom.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
