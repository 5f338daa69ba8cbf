"""Operators of a training-data pipeline: near-duplicate joins, sharding, archives, licence
scans, language models, quality rules, tokenising, decontamination, language ID, token files, Merkle
manifests, conversation tries, chat formatting.

Each module holds one operator with a general interface and a thin ``opN_<name>`` query over
the driver tables.  :mod:`dialstat.llm.registry` lists the queries and their DuckDB SQL.
Nothing else in the library imports this subpackage.

Functions that run inside Python tasks are shipped to the workers by value, so the workers need
numpy, pandas and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
