"""Task parameters: the JSON object a task row carries, plus behaviour options.

The JSON is one small object per task, decoded once on the driver (it is the
job's configuration, not data).  Every value is kept as the text the task
holds, as the reference reads it; list-valued keys are comma-separated text.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from typing import Any

from visitlens.schema import TASK_PARAM_KEYS


def _snake(name: str) -> str:
    return "".join("_" + ch.lower() if ch.isupper() else ch for ch in name)


# JSON keys of task_param -> attribute names here (startDate -> start_date, ...).
JSON_KEYS = {key: _snake(key) for key in TASK_PARAM_KEYS}


def _json_text(value: Any) -> str | None:
    """A JSON value as text: strings as is, arrays/objects as compact JSON."""
    if value is None:
        return None
    if isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (list, dict)):
        return json.dumps(value, separators=(",", ":"), ensure_ascii=False)
    return str(value)


def is_empty(value: str | None) -> bool:
    return value is None or value == ""


def tokens(value: str | None) -> list[str]:
    """Items of a list parameter: comma tokens, trimmed, empties dropped.

    A JSON array (how an array-valued task parameter arrives as text) gives
    its elements.
    """
    if is_empty(value):
        return []
    text = value.strip()
    if text.startswith("["):
        try:
            items = json.loads(text)
        except ValueError:
            items = None
        if isinstance(items, list):
            return [str(i).strip() for i in items if i is not None and str(i).strip()]
    return [t.strip() for t in value.split(",") if t.strip()]


@dataclass(frozen=True)
class TaskParams:
    """Filter parameters of one task and the options that pick a semantics.

      list_match     "token" (exact item of the comma list) | "substring"
                     (the list text contains the value, as the reference).
      keyword_mode   "any" (session searched any listed keyword) | "substring"
                     | "ignore" (no effect, as the reference).
      category_mode  same choices for clicked category ids.
      top_scope      "all": top-N over every session in the date range joined
                     to a user (as the reference); "filtered": only sessions
                     that pass the filters.
      split_ids      split order/pay id fields on commas (else one token).
      restrict_dates export detail only for actions inside the date range.
      extract_per_day number of sessions to draw per day; extract_seed salts
                     the repeatable draw.
    """

    start_date: str | None = None
    end_date: str | None = None
    start_age: str | None = None
    end_age: str | None = None
    professionals: str | None = None
    cities: str | None = None
    sex: str | None = None
    keywords: str | None = None
    category_ids: str | None = None

    list_match: str = "token"
    keyword_mode: str = "any"
    category_mode: str = "any"
    top_scope: str = "all"
    split_ids: bool = False
    restrict_dates: bool = False
    extract_per_day: int = 100
    extract_seed: str = "0"
    top_n: int = field(default=10)

    def __post_init__(self) -> None:
        checks = {
            "list_match": ("token", "substring"),
            "keyword_mode": ("any", "substring", "ignore"),
            "category_mode": ("any", "substring", "ignore"),
            "top_scope": ("all", "filtered"),
        }
        for name, allowed in checks.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, got {getattr(self, name)!r}")
        if self.extract_per_day < 0 or self.top_n < 1:
            raise ValueError("extract_per_day must be >= 0 and top_n >= 1")

    @classmethod
    def from_json(cls, text: str | None, **options: Any) -> "TaskParams":
        """Decode a task_param JSON object; a missing key or JSON null is absent."""
        obj = json.loads(text) if text else {}
        if not isinstance(obj, dict):
            raise ValueError("task_param must be a JSON object")
        values = {attr: _json_text(obj.get(key)) for key, attr in JSON_KEYS.items()}
        return cls(**values, **options)

    def to_json(self) -> str:
        obj = {k: getattr(self, a) for k, a in JSON_KEYS.items() if getattr(self, a) is not None}
        return json.dumps(obj, separators=(",", ":"))

    def with_options(self, **options: Any) -> "TaskParams":
        return replace(self, **options)

    def age_bounds(self) -> tuple[int | None, int | None]:
        def num(v: str | None) -> int | None:
            return None if is_empty(v) else int(v.strip())

        return num(self.start_age), num(self.end_age)
