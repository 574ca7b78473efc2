"""Landing readers and the layer table store."""
