"""skyledger: a PySpark analytics engine for catalogues of tracked space objects.

Layers (all plain DataFrame functions):

* ``skyledger.streaming.bronze``  envelope files -> bronze tables (triggered stream)
* ``skyledger.plans.silver``      typed, de-duplicated, joined, classified objects
* ``skyledger.plans.gold``        census, congestion, countries, constellations, decay, globe
* ``skyledger.plans.panels``      dashboard roll-ups, paging and formatted cells
* ``skyledger.plans.positions``   position grid (two-body + J2, not SGP4)
* ``skyledger.plans.history``     element history, snapshots, SCD2 versions
* ``skyledger.sources.export``    JSON export, manifest, file inventory
* ``skyledger.plans.pipeline``    ``run_batch`` / ``run_full`` scheduled runs
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark.cloudpickle import register_pickle_by_value as _by_value

# Functions that run in Python workers travel with the job, so executors need
# no installed copy of this package.
_by_value(_sys.modules[__name__])
