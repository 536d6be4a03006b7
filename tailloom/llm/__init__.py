"""Operations of a training-data pipeline over documents, pages and embeddings.

Nothing outside this package imports it.  Each module holds one operator with
a general interface; ``queries`` binds the operators to the given tables.
"""
