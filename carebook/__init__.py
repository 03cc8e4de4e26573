"""carebook: Spark jobs over a social-care diary and its population register.

Subpackages:

* ``sources``   - explicit schemas, batch readers, the day-partitioned export
* ``functions`` - shared column expressions (exact money sums, NTZ handling)
* ``operators`` - reusable DataFrame operators (bounded broadcast, skew-safe
  ordered scans, latest/top-k per key, missing calendar days)
* ``plans``     - the batch jobs, one function per report
* ``streaming`` - Structured Streaming jobs over arriving diary entries

``carebook.registry.JOBS`` names every job; ``python -m carebook`` runs them.
"""

__version__ = "0.1.0"
