from tickwise.functions.num import rnd, safe_div, surrogate_key, NULL_KEY_TOKEN

__all__ = ["rnd", "safe_div", "surrogate_key", "NULL_KEY_TOKEN"]
