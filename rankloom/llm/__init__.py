"""Training-data operators over ``documents`` and ``conversations``.

One module per operator plus ``queries`` (the registry) and ``oracle_sql``.  Nothing
outside this package and ``corpus_pipeline.py`` imports it.
"""
