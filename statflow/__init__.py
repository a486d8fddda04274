"""statflow: host-metric snapshots, CPU utilisation deltas, metric archives and
location reports as Spark DataFrame / Structured Streaming jobs.

Entry points: ``operators.cpu_delta.enrich`` (batch job 1),
``streaming.jobs`` (stream jobs), ``operators.places.enrich_addresses``
(location reports), ``python -m statflow`` (command line).
"""

__version__ = "0.1.0"
