"""A bounded memory of computed values, in two generations: when the newer is
full it becomes the older, from which values in use are taken over."""

from __future__ import annotations


class Recent(dict):
    def __init__(self, make, entries: int, longest: int = 64):
        self.make, self.half, self.longest, self.older = make, max(1, entries // 2), longest, {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value
