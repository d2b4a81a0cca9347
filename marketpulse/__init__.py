"""marketpulse: market and social time-series analytics as Spark DataFrame operators.

Layers follow the bronze -> silver -> gold layout: raw ticks/bars and posts are
normalised and de-duplicated (``sources``, ``operators.ingest``), turned into
bars and indicators (``operators.bars``, ``operators.indicators``) or scored
posts (``operators.social``, ``operators.sentiment``), and published as a star
schema (``operators.star``). ``operators.monitor`` holds pipeline-health
queries and ``streaming`` runs the same operators on Structured Streaming.
"""

from marketpulse.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
