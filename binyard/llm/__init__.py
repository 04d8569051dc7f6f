"""Operators for training-data pipelines over documents, pages and
conversations.  Nothing else in the library imports this subpackage;
``queries`` and ``oracle_sql`` are registered by the entry module only where it
can be imported."""
