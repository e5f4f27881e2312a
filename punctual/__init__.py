"""Schedule-adherence analytics on Spark.

Entry points: ``punctual.plans.transit`` (compose inputs -> arrivals -> delay
fact -> marts), ``punctual.operators`` (the operators), ``punctual.sources`` /
``punctual.sinks`` / ``punctual.streaming`` (I/O), ``punctual.catalog`` (the
registered queries and their oracles), ``punctual.session.get_session``.
"""

__version__ = "0.1.0"
