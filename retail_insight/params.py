"""Job parameters of the visit filter (start/end date, start/end age)."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

_BARE_KEY = re.compile(r'([{,]\s*)([A-Za-z_][A-Za-z0-9_]*)\s*:')


@dataclass(frozen=True)
class VisitFilter:
    """Inclusive bounds; an empty string or None leaves that side open.

    Dates are ``yyyy-MM-dd`` strings compared as text, as in the visit log.
    """

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | str | None = None
    end_age: int | str | None = None

    @staticmethod
    def _set(value) -> bool:
        return value is not None and str(value) != ""

    def bounds(self):
        """(column, op, value) triples for the bounds that are set."""
        out = []
        if self._set(self.start_date):
            out.append(("date", ">=", str(self.start_date)))
        if self._set(self.end_date):
            out.append(("date", "<=", str(self.end_date)))
        if self._set(self.start_age):
            out.append(("age", ">=", int(self.start_age)))
        if self._set(self.end_age):
            out.append(("age", "<=", int(self.end_age)))
        return out

    @classmethod
    def from_json(cls, text: str) -> "VisitFilter":
        """Parse the condition object; only the four bounds carry meaning."""
        obj = json.loads(text)
        return cls(obj.get("startDate"), obj.get("endDate"),
                   obj.get("startAge"), obj.get("endAge"))

    @classmethod
    def from_properties(cls, text: str, key: str = "condition.params.json") -> "VisitFilter":
        """Read the condition object from a properties file's text.

        Handles backslash line continuations and the unquoted object keys
        the reference's file uses.
        """
        joined = re.sub(r"\\\s*\n\s*", "", text)
        for line in joined.splitlines():
            name, sep, value = line.partition("=")
            if sep and name.strip() == key:
                return cls.from_json(_BARE_KEY.sub(r'\1"\2":', value.strip()))
        raise KeyError(key)
