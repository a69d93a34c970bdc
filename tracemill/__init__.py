"""Workflow-trace curation, features and evaluation as Spark jobs.

Every operator is a function ``DataFrame -> DataFrame`` (or a Column
expression) that only declares a plan; actions happen in sinks.
"""

__version__ = "0.1.0"
