"""Streaming.

The reference reads finished files only: it has no stream source, watermark,
event-time window or state.  Nothing is built here on purpose.  The one
operator that would run unchanged on a stream is batch scoring (E09), which
is map-only: :meth:`dichot.plans.jobs.ScoringModel.transform` accepts a
streaming DataFrame from ``spark.readStream`` as it is, and its output can go
to any ``writeStream`` sink.
"""
