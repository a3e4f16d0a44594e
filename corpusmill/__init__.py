"""corpusmill: corpus preparation as Spark jobs.

Subpackages: ``functions`` (column rules), ``sources`` (listing, selection,
tables, sinks), ``operators`` (labels, planning, ordering, reports,
conversion, citations), ``streaming`` (incremental runs), ``plans`` (jobs,
registered queries and their oracles).
"""

__version__ = "0.1.0"
