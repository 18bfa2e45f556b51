"""Span extraction from large document collections as Spark DataFrame plans.

``extract`` makes the result rows of a table of documents; ``expand_entities`` and ``clean_text`` are its steps for entities from elsewhere.
"""

__version__ = "0.2.0"
__all__ = ["__version__", "clean_text", "expand_entities", "extract"]


def __getattr__(name: str):
    """The library's functions, imported when they are first asked for."""
    if name == "extract":
        from spanloom.plans.extract import extract as found
    elif name == "expand_entities":
        from spanloom.functions.expansion import expanded as found
    elif name == "clean_text":
        from spanloom.functions.cleaning import cleaned as found
    else:
        raise AttributeError(name)
    return found
