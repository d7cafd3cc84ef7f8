"""A cache of bounded size inside a Python worker."""

from __future__ import annotations


class Recent(dict):
    """Values by key, made by ``make`` when missing. Two generations: the older one goes when the newer is full."""

    limit = 300_000

    def __init__(self) -> None:
        super().__init__()
        self.older: dict = {}

    def make(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
