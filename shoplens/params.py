"""Task parameters: the object that constrains a session / page / area task.

A blank string and a missing key both mean "no constraint" (lists) or "use the default" (dates).
Values are bound into plans as column literals, never concatenated into SQL text.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from shoplens.task_text import read_object


def _blank(value) -> bool:
    return value is None or (isinstance(value, str) and value.strip() == "")


def _int_or_none(value):
    return None if _blank(value) else int(value)


def _str_list(value) -> tuple[str, ...]:
    if _blank(value):
        return ()
    if isinstance(value, (list, tuple)):
        return tuple(str(v).strip() for v in value if str(v).strip())
    return tuple(v.strip() for v in str(value).split(",") if v.strip())


def _int_list(value) -> tuple[int, ...]:
    return tuple(int(v) for v in _str_list(value))


@dataclass(frozen=True)
class TaskParams:
    start_date: str | None = None  # unset: no bound
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[int, ...] = ()
    target_page_flow: tuple[int, ...] = ()
    extra: dict = field(default_factory=dict, compare=False)

    @classmethod
    def from_json(cls, text: str) -> "TaskParams":
        """From a JSON object, or one with bare names as in property files (``shoplens.task_text``)."""
        return cls.from_dict(read_object(text))

    @classmethod
    def from_dict(cls, raw: dict) -> "TaskParams":
        text = lambda key: None if _blank(raw.get(key)) else str(raw[key]).strip()
        return cls(
            start_date=text("startDate"),
            end_date=text("endDate"),
            start_age=_int_or_none(raw.get("startAge")),
            end_age=_int_or_none(raw.get("endAge")),
            professionals=_str_list(raw.get("professionals")),
            cities=_str_list(raw.get("cities")),
            sex=None if _blank(raw.get("sex")) else str(raw.get("sex")).strip(),
            keywords=_str_list(raw.get("keywords")),
            category_ids=_int_list(raw.get("categoryIds")),
            target_page_flow=_int_list(raw.get("targetPageFlow")),
        )

    def with_(self, **changes) -> "TaskParams":
        return replace(self, **changes)


# The date window of the scan queries, where it is the feature, the page flow of the registered queries (all others
# run over the whole tables), and the session constraints of the session / category / sampling ones ("S").
SCAN_PARAMS = TaskParams(start_date="2024-01-01", end_date="2024-01-20")
QUERY_PARAMS = TaskParams(target_page_flow=(1, 2, 3, 4, 5, 6, 7))
DEFAULT_SESSION_PARAMS = QUERY_PARAMS.with_(start_age=20, end_age=50, sex="male")
