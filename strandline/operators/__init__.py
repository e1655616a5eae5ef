"""DataFrame operators over scenes, observations, tides, points and pixels.

Observations are long: one row per transect and scene, NULL where missing.
"""
