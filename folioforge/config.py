"""Parameters of the stages."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ManifestConfig:
    context_chars: int = 80
    max_codes: int = 4
    early_limit: int = 500
    year_head_chars: int = 5000
    small_scan_max_bytes: int = 512
    min_search_tokens: int = 20
    report_text_chars: int = 4000
    small_file_max_bytes: int = 65536
    tokens_given: bool = False  # token counts are in a column token_count_e5
    text_by_stem: bool = False  # read codes and year from the first file with the same stem instead of the file itself


@dataclass(frozen=True)
class PagesConfig:
    min_chars: int = 20


@dataclass(frozen=True)
class QualityConfig:
    lines_format: str = "dict"  # or "compact"

    def __post_init__(self) -> None:
        if self.lines_format not in ("dict", "compact"):
            raise ValueError("lines_format is dict or compact")


@dataclass(frozen=True)
class CleaningConfig:
    min_word_len: int = 3


@dataclass(frozen=True)
class SplitConfig:
    max_words: int = 222
    overlap_words: int = 10

    def __post_init__(self) -> None:
        if not 0 <= self.overlap_words < self.max_words:
            raise ValueError("overlap_words must be at least 0 and under max_words")


@dataclass(frozen=True)
class PipelineConfig:
    manifest: ManifestConfig = field(default_factory=ManifestConfig)
    pages: PagesConfig = field(default_factory=PagesConfig)
    quality: QualityConfig = field(default_factory=QualityConfig)
    cleaning: CleaningConfig = field(default_factory=CleaningConfig)
    split: SplitConfig = field(default_factory=SplitConfig)
