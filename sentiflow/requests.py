"""Request parameters of the endpoints: parsing, trimming and clamps live here, not in the operators."""

from __future__ import annotations

from collections.abc import Iterable

# Limits of the endpoints.
DEFAULT_LIMIT, MAX_LIMIT = 50, 200
DEFAULT_MINUTES, MAX_MINUTES = 60, 1440


def leading_int(raw, default: int) -> int:
    """Integer prefix of a parameter (``"12px"`` -> 12); ``default`` when there is none."""
    text, digits = str(raw if raw is not None else "").strip(), ""
    for i, ch in enumerate(text):
        if ch in "0123456789" or (i == 0 and ch in "+-"):
            digits += ch
        else:
            break
    return int(digits) if digits.lstrip("+-") else default


def limit_param(raw, default: int = DEFAULT_LIMIT, maximum: int = MAX_LIMIT) -> int:
    """Number of rows asked for: at most ``maximum``, and none for a negative number."""
    return max(0, min(leading_int(raw, default), maximum))


def minutes_param(raw, default: int = DEFAULT_MINUTES, maximum: int = MAX_MINUTES) -> int:
    """Length of the series asked for, between 0 and ``maximum`` minutes."""
    return max(0, min(leading_int(raw, default), maximum))


def tags_param(raw: str | None) -> list[str]:
    """Tag list: split on commas, trim white space of any kind, strip one leading ``#``, drop empties."""
    parts = (part.strip().removeprefix("#") for part in (raw or "").split(","))
    return [part for part in parts if part]


def search_tags(raw: str | Iterable[str] | None) -> list[str]:
    """The tags of a search, which needs one at least."""
    tags = tags_param(raw) if raw is None or isinstance(raw, str) else [t for t in raw if t]
    if not tags:
        raise ValueError("a search needs at least one hashtag")
    return tags
