"""Column-level building blocks: schemas, strict JSON decoding, keys and URLs."""
