"""The parameters of a job: one immutable value, empty means unrestricted."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass


# A quoted string, which stays as it is, or else a bare key.
_BARE_KEY = re.compile(r'("(?:[^"\\]|\\.)*")|([A-Za-z_]\w*)(?=\s*:)')


def _words(text: str | None) -> tuple[str, ...]:
    return tuple(w for w in (text or "").split(",") if w)


def _number(value: object) -> int | None:
    return None if value in (None, "") else int(str(value))


@dataclass(frozen=True)
class TaskParams:
    start_date: str
    end_date: str
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()
    page_flow: tuple[int, ...] = ()

    @classmethod
    def from_dict(cls, raw: dict) -> TaskParams:
        """Read the job's JSON keys; lists come as comma-separated text."""
        return cls(
            start_date=raw["startDate"],
            end_date=raw["endDate"],
            start_age=_number(raw.get("startAge")),
            end_age=_number(raw.get("endAge")),
            professionals=_words(raw.get("professionals")),
            cities=_words(raw.get("cities")),
            sex=raw.get("sex") or None,
            keywords=_words(raw.get("keywords")),
            category_ids=tuple(int(c) for c in _words(raw.get("categoryIds"))),
            page_flow=tuple(int(p) for p in _words(raw.get("targetPageFlow"))),
        )

    @classmethod
    def from_json(cls, text: str) -> TaskParams:
        """Read a JSON object; its keys may lack their quotes."""
        try:
            raw = json.loads(text)
        except json.JSONDecodeError:
            raw = json.loads(_BARE_KEY.sub(lambda m: m[1] or f'"{m[2]}"', text))
        return cls.from_dict(raw)
