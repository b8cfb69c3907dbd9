"""Registered queries (``catalog.REGISTRY``) and their SQL oracles (``catalog.ORACLE``)."""


def load_all():
    """Import every query module (registration happens at import) and return the
    catalog module."""
    from marketweave.plans import catalog
    from marketweave.plans import market_queries  # noqa: F401
    from marketweave.plans import text_queries  # noqa: F401
    from marketweave.plans import table_queries  # noqa: F401
    from marketweave.plans import sentiment_queries  # noqa: F401
    from marketweave.plans import feature_queries  # noqa: F401
    from marketweave.plans import stream_queries  # noqa: F401
    from marketweave.plans import process_queries  # noqa: F401

    return catalog
