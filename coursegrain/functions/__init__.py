from . import classify, keys, numbers, paths, text

__all__ = ["classify", "keys", "numbers", "paths", "text"]
