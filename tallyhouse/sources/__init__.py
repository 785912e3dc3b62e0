"""Raw schemas, CSV landing, layer publishing, and the adapter over the test tables."""
