"""Job settings from a file, checked against what the job knows."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class NearDuplicateJob:
    """What a near-duplicate search is told."""

    input: str
    output: str
    tokenization: str = "character"
    window_size: int = 6
    hamming_distance: int = 4
    num_blocks: int = 5
    ignore_punctuation: bool = True
    lowercase: bool = True
    text_column: str = "text"
    id_column: str = "doc_id"


def _scalar(text: str) -> Any:
    """A plain value of YAML's flat subset: JSON, or else a word."""
    try:
        return json.loads(text)
    except ValueError:
        return {"yes": True, "no": False, "~": None, "": None}.get(text.lower(), text.strip("'\""))


def settings(text: str) -> dict[str, Any]:
    """The ``key: value`` lines of a flat YAML file, or a JSON object."""
    if text.lstrip().startswith("{"):
        return json.loads(text)
    rows = (line.split(" #")[0].rstrip() for line in text.splitlines() if line.strip() and not line.lstrip().startswith(("#", "---")))
    return {k.strip(): _scalar(v.strip()) for k, _, v in (r.partition(":") for r in rows)}


def load(path: str, kind: type = NearDuplicateJob) -> Any:
    """The settings of a file as a job; unknown and missing names are errors."""
    found = settings(Path(path).read_text(encoding="utf-8"))
    known = {f.name for f in fields(kind)}
    if found.keys() - known:
        raise ValueError(f"unknown settings: {', '.join(sorted(found.keys() - known))}")
    return kind(**found)
