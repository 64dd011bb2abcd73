"""reportflow: operational report reconciliation as Spark jobs.

Sub-packages: ``functions`` (Column rules), ``operators`` (DataFrame -> DataFrame
operators), ``sources`` (report scans, archives, table slices), ``sinks``
(snapshot tables, appends, readable exports), ``plans`` (report specs,
pipelines and the router), ``streaming`` (consume-once landing folder) and
``suite`` (the registered queries and their SQL oracles).
"""

__version__ = "0.1.0"
