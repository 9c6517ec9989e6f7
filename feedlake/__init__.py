"""feedlake: REST/JSON feed ingestion as Spark DataFrame operators.

Layout
  sources/    request tables, the ``rest_json`` data source, executor-side fetch,
              landing tables, and feed rendering of warehouse tables as API payloads
  functions/  column expressions: lax coercion, text slices, labels, params, URLs
  operators/  flatten + validation, filters, fan-out alignment, rate rules, retry,
              run metrics and log parsing
  sinks/      partitioned Parquet, single dataset, CSV, batching, format routing
  plans/      end-user jobs (matches, standings, scorers, team, season dump, bulk)
              and the registered query catalog
  streaming/  incremental landing -> flatten -> sink with ``availableNow``
"""

__version__ = "0.1.0"
