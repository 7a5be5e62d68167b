"""Run parameters and the named configurations."""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, replace


@dataclass(frozen=True)
class StoryParams:
    window_size: int = 14  # days an article stays in the window
    slide_size: int = 7  # days added per step
    num_windows: int | None = None  # all slides by default
    min_articles: int = 6  # smallest new cluster
    n_keywords: int = 10
    temperature: float = 4
    keyword_score: str = "tfidf"  # or "bm25"
    time_aware: bool = True
    theme_aware: bool = True
    seed: int = 0

    def __post_init__(self):
        if self.keyword_score not in ("tfidf", "bm25"):
            raise ValueError(f"unknown keyword score: {self.keyword_score}")
        if min(self.window_size, self.slide_size, 1 if self.num_windows is None else self.num_windows, self.min_articles, self.n_keywords) < 1:
            raise ValueError("sizes must be at least 1")

    @property
    def live_slides(self) -> int:
        return math.ceil(self.window_size / self.slide_size)

    def with_(self, **changes) -> "StoryParams":
        return replace(self, **changes)

    def as_dict(self) -> dict:
        return asdict(self)


BATCH = StoryParams()
DAILY = StoryParams(num_windows=1)
TIGHT = StoryParams(min_articles=5)
THEMATIC = StoryParams(
    window_size=28, slide_size=14, num_windows=8, min_articles=20, temperature=3, n_keywords=15
)
SWEEP_BASE = StoryParams(min_articles=15, temperature=2)
BATCH_DAYS = 30
