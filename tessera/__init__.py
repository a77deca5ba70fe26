"""tessera: document and table analytics expressed as Spark DataFrame plans.

Sub-packages
------------
functions  Column builders: type conversions, where-trees, document predicates, text helpers.
operators  DataFrame -> DataFrame operators: side tables, statements, documents, nodes, rules,
           pages, templates, search, crawl.
sources    Readers and writers: markup documents, HTML node table, line lists.
plans      The registered queries over the test tables and their DuckDB oracles.
streaming  Structured Streaming forms of the incremental operators.
"""

from tessera.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
