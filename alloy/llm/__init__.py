"""Training-data operators (one module each) and their queries.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
``alloy.llm.queries`` when it can be imported.
"""
