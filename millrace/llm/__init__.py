"""Training-data operators. Nothing outside this folder, its tests and corpus_pipeline.py needs it."""
