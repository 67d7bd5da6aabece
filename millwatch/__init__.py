"""Machine telemetry risk engine on Spark DataFrames.

Readings are typed (bronze), checked and flagged (silver), aggregated into
risk per machine, plant and day (gold) and served as leaderboards, plant
summaries and counters. Every operator takes and returns DataFrames; reads and
writes live in ``sources``.
"""
