"""Training-data operators: licence scan, line dedup, embedding near-dedup,
nearest neighbours, toxicity, source mixing, URL reputation, chat formatting,
SimHash near-dedup and packing.  Nothing outside this folder (but the guarded
registration and ``corpus_pipeline.py``) imports it."""
