"""Training-data operators over documents, pages and embeddings.

Nothing outside this package imports it, so the transit engine works without it.
"""
