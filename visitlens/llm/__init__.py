"""Operators of a training-data pipeline over ``documents``, ``embeddings`` and ``pages``.

Every operator reads only the columns it names, so further columns (and clashing names
among them) never matter.  Work on text runs in Arrow batches inside Spark tasks; joins,
groupings and iterations are DataFrame operations.
"""
