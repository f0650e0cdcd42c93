"""Queries over streams.

The query layer has no operators of its own for streams. Its steps lower to plain
DataFrame operations, so filters, projections, joins with stored entities and
``distinct`` also apply to an entity whose source is a streaming DataFrame, and
``Query.to_df()`` can be written with ``writeStream``.
"""
