"""Training-data operators: thirteen Spark jobs over documents, pages and conversations.

Nothing else in the library imports this package. Each module holds one operator with its own
general interface; ``queries.py`` registers the thin queries that apply them to whole tables.
"""
