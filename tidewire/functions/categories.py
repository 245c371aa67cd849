"""Categories of short texts by ordered keyword rules, and a reader's profile."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, bounded, bounded_name, normalize_text

# Rules in order, the first that has a keyword in the text decides.
RULES = (
    ("acquisition", ("acquires", "acquisition", "acquired", "buys", "merger", "takeover")),
    ("funding", ("raises", "funding round", "series a", "series b", "series c", "series d", "valuation", "seed round", "ipo", "investment")),
    ("security", ("vulnerability", "exploit", "cve", "breach", "malware", "prompt injection", "jailbreak", "attack", "data leak")),
    ("policy", ("regulation", "regulator", "lawsuit", "court", "copyright", "ban", "legislation", "act", "compliance", "antitrust", "executive order")),
    ("safety", ("alignment", "safety", "red team", "misuse", "guardrail", "responsible ai", "interpretability", "evaluation of risk")),
    ("benchmark", ("benchmark", "leaderboard", "state of the art", "sota", "eval suite", "scores")),
    ("model_release", ("introducing", "releases", "release", "launches", "launch", "announcing", "now available", "unveils", "general availability", "preview")),
    ("open_source", ("open source", "open sources", "open weights", "apache 2", "mit license", "weights")),
    ("ai_agents", ("agent", "agents", "agentic", "tool use", "autonomous", "multi agent")),
    ("developer_tools", ("sdk", "api", "cli", "ide", "developer", "library", "framework", "plugin", "extension")),
    ("infrastructure", ("gpu", "data center", "datacenter", "cluster", "inference", "training run", "chip", "accelerator", "compute", "serving")),
    ("research", ("paper", "arxiv", "we propose", "we present", "study", "findings", "preprint")),
    ("product", ("feature", "update", "rollout", "users can", "app", "pricing", "subscription")),
)
CATEGORIES = ("model_release", "research", "open_source", "developer_tools", "ai_agents", "infrastructure", "funding", "acquisition", "policy", "safety", "benchmark", "security", "product", "other")


def has_word(padded: Column, words: Sequence[str]) -> Column:
    """Whether a normalised text padded by blanks has one of the words or phrases."""
    found = F.lit(False)
    for w in words:
        found |= F.contains(padded, F.lit(f" {w} "))
    return found


def classify(title: Column, summary: Column, source_id: Column | None = None) -> Column:
    padded = F.concat(F.lit(" "), normalize_text(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit("")))), F.lit(" "))
    paper = F.startswith(F.coalesce(source_id, F.lit("")), F.lit("arxiv")) if source_id is not None else F.lit(False)

    def named(words_: Column) -> Column:
        out = F.when(F.lit(False), F.lit(""))
        for name, words in RULES:
            out = out.when(has_word(words_, words), F.lit(name))
        return out.otherwise(F.lit("other"))

    return F.when(paper, F.lit("research")).otherwise(bound(padded, named))


@dataclass(frozen=True)
class Profile:
    """What a reader cares about: terms sought, terms of low interest, and weights of categories (0 to 1)."""

    interests: tuple[str, ...] = ()
    low_interest: tuple[str, ...] = ()
    category_weights: dict[str, float] = field(default_factory=dict)
    default_weight: float = 0.5

    def __post_init__(self) -> None:
        for name in ("interests", "low_interest"):
            object.__setattr__(self, name, tuple(sorted({t.strip().lower() for t in getattr(self, name) if t.strip()})))
        if bad := {k: v for k, v in self.category_weights.items() if not 0 <= v <= 1 or k not in CATEGORIES}:
            raise ValueError(f"category weights have to be of known categories and within 0 and 1: {bad}")

    def hits(self, text: Column, terms: Sequence[str]) -> Column:
        """How many of the terms occur as whole words."""
        marked = bounded(text)
        flags = [F.contains(marked, F.lit(bounded_name(t))).cast("int") for t in terms]
        return sum(flags, F.lit(0))

    def weight_for(self, category: Column) -> Column:
        out = F.when(F.lit(False), F.lit(0.0))
        for name, value in self.category_weights.items():
            out = out.when(category == name, F.lit(float(value)))
        return out.otherwise(F.lit(self.default_weight))
