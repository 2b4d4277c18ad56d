"""tessera — tabular preparation and regression on Spark.

Every operator is a function from DataFrame to DataFrame (or to a small
parameter DataFrame); configs are plain dicts. The most used entry points:

>>> from tessera import session, config
>>> from tessera.plans import jobs
>>> spark = session.get_session()
>>> result = jobs.train_job(df, config.housing_config())        # doctest: +SKIP
>>> preds, dropped = jobs.score_batch(new_rows, cfg, result.params, result.coefficients)  # doctest: +SKIP

Modules: ``sources`` (readers, records, sinks), ``operators`` (validate, profile,
quantiles, clean, features, transform, select, split, model, metrics, joins),
``plans`` (views over the driver tables, jobs, the query catalog),
``streaming`` (file-source scoring), ``functions`` (column helpers).
"""

__version__ = "0.1.0"
