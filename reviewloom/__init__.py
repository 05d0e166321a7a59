"""Review analytics on Spark: features, text sets, vectors, retrieval and metrics as DataFrame plans."""

from reviewloom.session import build_session

__all__ = ["build_session"]
