"""lakeload: incremental table loading and auditing as Spark DataFrame operators.

    lakeload.sources     file, connector and inventory scans
    lakeload.sinks       raw appends, table creation, schema evolution, copies
    lakeload.operators   casts and predicates, dedup, merge, joins, audit, run windows,
                         job statistics, configuration layers, retention
    lakeload.functions   scalar column functions (run ids, sequences, JSON attributes)
    lakeload.plans       end-to-end upsert and landing plans; the registered checks
    lakeload.streaming   incremental file landing with Structured Streaming
"""

__version__ = "0.1.0"
