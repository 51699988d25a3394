"""Settings: the command line over an INI file over defaults."""

from __future__ import annotations

import configparser
from datetime import date


class Settings:
    def __init__(self, ini: str | None = None, given: dict[str, object] | None = None):
        self.file = configparser.ConfigParser()
        if ini:
            self.file.read(ini, encoding="utf-8")
        self.given = {k: v for k, v in (given or {}).items() if v is not None}

    def get(self, name: str, default, section: str = "main"):
        """The setting as the default's type; a value that can't be read as that counts as missing."""
        raw = self.given.get(name, self.file.get(section, name, fallback=None))
        if raw is None or (isinstance(raw, str) and not raw.strip()):
            return default
        try:
            if isinstance(default, bool):
                return raw if isinstance(raw, bool) else str(raw).strip().lower() in ("1", "true", "yes", "on")
            return raw if default is None else type(default)(raw)
        except (TypeError, ValueError):
            return default

    def least_year(self, today: date, years: int = 1) -> int:
        return today.year - int(self.get("years", years)) + 1

    def words(self, name: str, section: str = "scoring") -> dict[str, int]:
        """ "kw:3,kw2:2" -> weights; entries without a number are left out."""
        out = {}
        for part in str(self.get(name, "", section)).replace("，", ",").split(","):
            k, _, v = part.rpartition(":")
            if k.strip() and v.strip().lstrip("+-").isdigit():
                out[k.strip()] = int(v)
        return out
