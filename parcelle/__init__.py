"""parcelle: property-sale analytics as Spark DataFrame operators.

Every operator is a DataFrame -> DataFrame function whose column names and
thresholds are arguments; see ``parcelle.plans.catalog`` for the registered
queries and ``parcelle.plans.pipelines`` for the end-to-end entry points.
"""

__version__ = "0.1.0"
