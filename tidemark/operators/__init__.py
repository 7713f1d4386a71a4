"""DataFrame -> DataFrame building blocks: parse, traffic metrics, offsets,
size-checked joins and landing tables.  Same code for batch and stream."""
