"""Word lists and suffix rules, as data."""

from __future__ import annotations

import pkgutil


def lines(name: str) -> list[list[str]]:
    """The words of each line of a data file."""
    return [x.split() for x in pkgutil.get_data(__name__, name).decode("utf-8").splitlines() if x.strip()]


def word_lists(name: str) -> dict[str, list[str]]:
    """language -> words; an underscore stands for a blank in a word."""
    return {x[0]: [*dict.fromkeys(w.replace("_", " ") for w in x[1:])] for x in lines(name)}
