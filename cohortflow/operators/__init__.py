"""DataFrame -> DataFrame operators."""

from cohortflow.operators import clean, cohort, features, metrics, model, ordering, sequences, vocab

