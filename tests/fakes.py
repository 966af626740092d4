"""Lookups that misbehave."""

from cloakline.operators import lookup as L


class ShortLookup:
    """Answers one value too few (a malformed service response)."""

    def __call__(self, values):
        return ["p_" + v for v in values[:-1]]


class NeverLookup:
    """Never answers."""

    def __call__(self, values):
        return None


class NullLookup:
    """Answers null for values that start with ``x``."""

    def __call__(self, values):
        return [None if v.startswith("x") else "p_" + v for v in values]


class Service:
    """Refuses or answers wrongly any call with a bad value, or over a limit of bytes; counts its calls."""

    def __init__(self, bad=(), limit=None, wrong=None):
        self.bad, self.limit, self.wrong, self.calls, self.sizes = set(bad), limit, wrong, 0, []

    def __call__(self, values):
        self.calls += 1
        self.sizes.append(len(values))
        if self.limit is not None and sum(map(L.value_cost, values)) > self.limit:
            raise L.TooLargeError("over the limit")
        if self.bad & set(values):
            if self.wrong == "short":
                return values[:-1] if len(values) > 1 else []
            if self.wrong == "null":
                return [None if v in self.bad else "p" + v for v in values]
            if self.wrong == "text":
                return "oops"
            raise L.RefusedError("refused")
        return ["p" + v for v in values]
