"""lakestrata: a Bronze / Silver / Gold medallion pipeline on Spark DataFrames.

Layout:
    sources/    landed pages, versioned Bronze tables, progress, manifests,
                versioned derived tables, adapters over the driver tables
    functions/  Column expressions (JSON fields, guarded casts, predicates)
    operators/  dedupe, Silver parsing, Gold views, contracts and audits
    plans/      multi-step jobs: batch ingest, refresh order, run gating
    streaming/  Structured Streaming ingest (foreachBatch, availableNow)
"""

__version__ = "0.1.0"
