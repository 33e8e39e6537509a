"""Named extension points."""

from __future__ import annotations

from collections.abc import Callable


class Registry[T]:
    """Functions or values by key. A key is taken once; an unknown key is an error that lists the known ones."""

    def __init__(self, kind: str) -> None:
        self.kind, self._known = kind, {}

    def register(self, key: str) -> Callable[[T], T]:
        def add(value: T) -> T:
            if key in self._known:
                raise ValueError(f"{self.kind} {key!r} is registered already")
            self._known[key] = value
            return value

        return add

    def get(self, key: str) -> T:
        if key not in self._known:
            raise KeyError(f"no {self.kind} {key!r}; known: {', '.join(sorted(self._known))}")
        return self._known[key]

    def keys(self) -> list[str]:
        return sorted(self._known)
