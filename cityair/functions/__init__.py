from cityair.functions import constants, expressions

__all__ = ["constants", "expressions"]
