"""dialstat: parameterised table operators and reports for sales and call-centre analytics,
written as Spark DataFrame plans.

* :mod:`dialstat.sources`   typed reads, CSV export, report inputs from the driver tables
* :mod:`dialstat.functions` scalar column functions (rates, money text, postcode)
* :mod:`dialstat.operators` lookups, aggregates, top-k / top-n, data-quality gates
* :mod:`dialstat.plans`     the six reports, the report job, the driver query catalogue
"""

__version__ = "0.1.0"
