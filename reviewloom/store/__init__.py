"""Feature store: view declarations, historical retrieval, materialisation and online lookup."""

from reviewloom.store.registry import Entity, FeatureView, Partial, Registry, Source, batch_feature_view
from reviewloom.store.feature_store import FeatureStore

__all__ = ["Entity", "FeatureStore", "FeatureView", "Partial", "Registry", "Source", "batch_feature_view"]
