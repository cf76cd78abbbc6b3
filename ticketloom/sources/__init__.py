"""Reading corpora, logs and sheets; writing splits, logs and reports."""
