"""Seismic-event analytics as Spark DataFrame transformations.

Documents come in (files, a landing table or a topic), are decoded, flattened
and normalised into a raw event log, kept current by a last-write-wins key, and
served as counts by place and hour and average magnitudes by place and day.
"""
