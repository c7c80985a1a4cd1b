"""No streaming operators: the pipeline being rebuilt has no streams, state
stores, watermarks or triggers. Its daily incremental extraction is a batch
job per valid date, built here as an idempotent partition overwrite of a
``valid_date``-partitioned dataset (see ``cohortkit.sources.io.write_daily``)
over a date spine (``cohortkit.operators.batch``)."""
