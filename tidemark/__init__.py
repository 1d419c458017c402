"""Evidence-backed metadata curation on Spark: every step is a set-oriented DataFrame transformation."""
