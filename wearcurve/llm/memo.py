"""A bounded memo: texts repeat their words, so what a word gives is worked out once per Python worker."""

from __future__ import annotations

from collections.abc import Callable

#: Entries of one generation of a memo. A full generation becomes the old one and the old one goes, so a worker's
#: memory stays bounded whatever the texts hold, and what is used often stays.
LIMIT = 250_000


class Memo(dict):
    """``memo[key]`` is ``make(key)``, kept for two generations. Texts over 64 characters are not kept."""

    def __init__(self, make: Callable, limit: int = LIMIT):
        super().__init__()
        self.make = make
        self.limit = limit
        self.old: dict = {}

    __hash__ = object.__hash__  # a memo is itself, whatever it holds

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if type(key) is str and len(key) > 64:
                return value
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value


#: Objects built once per Python worker, such as vocabularies; a few at a time.
_HELD: dict[str, object] = {}


def let_go() -> None:
    """Free what a worker holds for stages that are over; it is built again if it is asked for."""
    _HELD.clear()


def held(key: str, build: Callable):
    """What ``build()`` gives, built once per worker for each key; the four newest stay."""
    found = _HELD.get(key)
    if found is None:
        while len(_HELD) >= 4:
            _HELD.pop(next(iter(_HELD)))
        found = _HELD[key] = build()
    return found
