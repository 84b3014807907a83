"""Training-data pipeline operators (extraction, dedup, search, quality,
formatting, decontamination, mixing, archives, secret scanning).

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it."""
