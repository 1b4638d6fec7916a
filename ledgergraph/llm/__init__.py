"""Training-data operators over the corpus tables; nothing outside this folder imports it."""
