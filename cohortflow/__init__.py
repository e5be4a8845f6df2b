"""cohortflow: clinical-event tables -> visit sequences -> scored cohorts, on Spark."""

__version__ = "0.1.0"
