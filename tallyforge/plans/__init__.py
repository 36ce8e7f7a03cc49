"""Views of the given tables, and queries on them with their SQL."""

# here and not in the registry, so that a worker may import any of these first
from tallyforge.plans import queries_corpus, queries_files, queries_intake, queries_runs, queries_store  # noqa: F401
