"""kiln: Spark-native data work for persona fine-tuning datasets and their scoring.

Every operator is a ``DataFrame -> DataFrame`` function with keyword options,
chained with ``DataFrame.transform``.  Column-level helpers live in
``kiln.functions``; DataFrame operators in ``kiln.operators``; readers and
writers in ``kiln.sources``; the four end-to-end chains and the query
catalog in ``kiln.plans``.
"""

from kiln.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
