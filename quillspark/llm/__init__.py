"""Training-data pipeline operators (see README, "Training-data operators").

Nothing outside this package imports it but the entry point, which adds
``queries.QUERIES``.
"""
