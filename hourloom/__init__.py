"""hourloom — work-registration analytics as Spark DataFrame jobs.

Subpackages:

* ``sources``   — table scans, multi-database unions, CSV/Parquet/JSON sinks (A1-A10).
* ``functions`` — pure ``Column`` expressions: projections, casts, dates, cyclic encodings,
                  quantity buckets (B*, C*, D*, N*, X1, X2).
* ``operators`` — DataFrame-in / DataFrame-out operators: filters, joins, aggregates,
                  history windows, geo, text vectors, encoders, quality reports, metrics, models.
* ``plans``     — compositions of the operators (system A/B preparation, merge, training) and the
                  registered query catalogue used by ``__spark_entry__``.
"""

from hourloom.session import checkpoint_dir, get_spark  # noqa: F401
