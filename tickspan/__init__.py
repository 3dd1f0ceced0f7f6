"""tickspan: daily price analytics as Spark DataFrame plans.

Layers (each a plain function returning a lazy DataFrame):

* ``sources``   – raw price rows, the watchlist, the holiday seed, the date spine,
                  landed API documents, and sinks that write the layers.
* ``functions`` – small column-expression helpers (safe division, date parts, text).
* ``operators`` – reusable DataFrame operators (latest-load dedup, one-pass
                  indicators, calendar, period summary, watchlist change fold,
                  data-quality checks, per-ticker analytics).
* ``plans``     – the staging → core → marts model graph composed from operators.
* ``streaming`` – incremental landing of API documents into the raw table.
"""

__version__ = "0.1.0"
