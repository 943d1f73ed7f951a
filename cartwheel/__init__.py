"""cartwheel: real-time commerce analytics as Spark DataFrame jobs.

Every transformation is a ``DataFrame -> DataFrame`` function used by both
batch jobs and Structured Streaming wrappers; Catalyst/AQE do the planning.
"""

__version__ = "0.1.0"
