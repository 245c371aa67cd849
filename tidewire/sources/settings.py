"""Settings of a run from an environment or a .env text: checked ranges, blanks as absent."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields


class SettingsError(ValueError):
    """A setting cannot be used."""


# Defaults and ranges of the numbers.
RANGES = {
    "lookback_hours": (1, 168), "memory_days": (1, 90), "event_memory_days": (1, 90), "shortlist": (1, 100), "per_category": (1, 100), "stories": (1, 20), "least_stories": (0, 20), "model_calls": (0, 500),
}


@dataclass(frozen=True)
class Settings:
    data_dir: str = "data"
    site_dir: str | None = None
    lookback_hours: int = 24
    memory_days: int = 7
    event_memory_days: int = 14
    shortlist: int = 20
    per_category: int = 4
    stories: int = 5
    least_stories: int = 3
    model_calls: int = 60
    local_url: str | None = None
    local_model: str = "local"
    hosted_url: str | None = None
    hosted_model: str | None = None
    hosted_key: str | None = None

    @property
    def hosted(self) -> list[tuple[str, str, str]]:
        """(url, model, key) of the hosted provider, if all three are set."""
        one = (self.hosted_url, self.hosted_model, self.hosted_key)
        return [one] if all(one) else []


def dotenv(text: str) -> dict[str, str]:
    """NAME=value lines; comments and lines without '=' are left out, one pair of quotes around a value is dropped."""
    found = {}
    for line in text.splitlines():
        name, sign, value = line.strip().removeprefix("export ").partition("=")
        if sign and name.strip() and not name.startswith("#"):
            value = value.strip()
            found[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
    return found


def load_settings(env: Mapping[str, str], file: str = "", prefix: str = "TIDEWIRE_") -> Settings:
    """Settings of names such as TIDEWIRE_STORIES; the environment goes before the file, blanks count as absent."""
    given = dotenv(file) | {k: v for k, v in env.items() if v.strip()}
    values = {}
    for f in fields(Settings):
        raw = (given.get(prefix + f.name.upper()) or "").strip()
        if not raw:
            continue
        if f.name not in RANGES:
            values[f.name] = raw
            continue
        low, high = RANGES[f.name]
        try:
            number = int(raw)
        except ValueError as e:
            raise SettingsError(f"{f.name} isn't a whole number: {raw}") from e
        if not low <= number <= high:
            raise SettingsError(f"{f.name} has to be within {low} and {high}, not {number}")
        values[f.name] = number
    return Settings(**values)
