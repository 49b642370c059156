"""toksmith: subword tokenization and token analytics as Spark DataFrame jobs.

Models (merge lists, vocabularies, special tokens) are small tables whose size
is bounded by the vocabulary size; corpora are DataFrames of any size.  Every
operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, joins, aggregations and windows.
"""

from toksmith.session import get_session, checkpoint_dir  # noqa: F401
