"""A cache of bounded size for what a Python worker has worked out."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Generic, TypeVar

V = TypeVar("V")


class Generations(Generic[V]):
    """Values by text in two generations of ``size`` keys.

    What is used again moves to the young generation; when that is full the old one goes. Keys of
    more than ``letters`` letters are kept for one call alone.
    """

    def __init__(self, size: int, letters: int):
        self.size, self.letters = size, letters
        self.young: dict[str, V] = {}
        self.old: dict[str, V] = {}
        self._long: list[str] = []

    def having(
        self, keys: Iterable[str], learn: Callable[[list[str]], dict[str, V]]
    ) -> dict[str, V]:
        """A table with all ``keys``, good until the next call; new ones are learned together."""
        for key in self._long:
            del self.young[key]
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = dict.fromkeys(k for k in keys if k not in young)
        for key in new:
            new[key] = old.get(key)
        new.update(learn([k for k, known in new.items() if known is None]))
        young.update(new)
        self._long = [k for k in new if len(k) > self.letters]
        return young
