"""hirelake: a PySpark engine that turns raw job-board payloads into a star schema.

Layers (all DataFrame / Column functions, planned by Catalyst):

* ``sources``   landing JSON, bronze table, taxonomy seed, driver test tables
* ``functions`` Column-level building blocks (regex dialect, JSON paths, text)
* ``operators`` DataFrame operators (classifiers, salary parsing, dedup, skill match,
                metrics, data-quality checks, insert-only merge)
* ``plans``     end-to-end compositions: silver, gold, posting fixture
* ``streaming`` incremental landing ingest with Structured Streaming
"""

__all__ = ["session"]
