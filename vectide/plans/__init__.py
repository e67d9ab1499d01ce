from vectide.plans import (  # noqa: F401
    ann_queries,
    chunk_queries,
    collection_queries,
    evaluation_queries,
    recall_queries,
    stream_queries,
    text_queries,
    vector_queries,
)
from vectide.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
