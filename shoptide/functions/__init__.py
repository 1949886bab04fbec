"""Column expressions: no shuffles, usable in batch and streaming alike."""
