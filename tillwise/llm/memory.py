"""What a task remembers about words, bounded and given up when the task ends."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any


class Memory(dict):
    """Values of a function by its argument; the older half goes when both halves are full.

    What was used since the last change of halves stays, so frequent words are kept while
    words that occur once pass through.
    """

    def __init__(self, make: Callable[[Any], Any], half: int):
        super().__init__()
        self.make, self.half, self.older = make, half, {}

    def __missing__(self, key: Any) -> Any:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value

    def remembered(self, key: Any) -> Any:
        """The value of ``key``, None if it is not remembered."""
        value = self.get(key)
        if value is None and (value := self.older.get(key)) is not None:
            self.keep(key, value)
        return value

    def keep(self, key: Any, value: Any) -> None:
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value

    def forget(self) -> None:
        self.older = {}
        self.clear()
