from basketry.functions import encode, parse

__all__ = ["encode", "parse"]
