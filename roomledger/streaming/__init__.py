"""The work is monthly batches: there is no streaming source, window or state to build.

Late data is replayed (plans.replay), and state is kept as monthly snapshots
(sources.tables).
"""
