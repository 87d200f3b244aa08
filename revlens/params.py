"""Job parameters, checked when they are made, so before any job starts."""

from __future__ import annotations

from dataclasses import dataclass, field

from revlens import fixed_values as fixed


class ParamError(ValueError):
    """A parameter is missing or out of range."""


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ParamError(message)


@dataclass(frozen=True)
class ModelParams:
    """What a judge or summarizer is called with; a null temperature is not sent."""

    model_id: str = "offline"
    max_tokens: int = fixed.MAX_TOKENS
    temperature: float | None = None

    def __post_init__(self):
        _require(bool(self.model_id), "model_id must not be empty")
        _require(self.max_tokens > 0, f"max_tokens must be positive: {self.max_tokens}")
        _require(
            self.temperature is None or 0.0 <= self.temperature <= 1.0,
            f"temperature must be null or within 0..1: {self.temperature}",
        )


@dataclass(frozen=True)
class QualityParams:
    threshold: float = fixed.QUALITY_THRESHOLD
    scale_min: int = fixed.SCALE_MIN
    scale_max: int = fixed.SCALE_MAX

    def __post_init__(self):
        _require(
            self.scale_min < self.scale_max,
            f"scale_min {self.scale_min} must be below scale_max {self.scale_max}",
        )
        _require(
            self.scale_min <= self.threshold <= self.scale_max,
            f"threshold {self.threshold} must be within {self.scale_min}..{self.scale_max}",
        )


@dataclass(frozen=True)
class ReviewRules:
    """Limits of a valid review. The id patterns are parameters because the
    default review id has room for ten thousand reviews only."""

    review_id_pattern: str = fixed.REVIEW_ID_PATTERN
    product_id_pattern: str = fixed.PRODUCT_ID_PATTERN
    languages: tuple[str, ...] = fixed.LANGUAGES
    rating_min: int = fixed.RATING_MIN
    rating_max: int = fixed.RATING_MAX
    title_max: int = fixed.TITLE_MAX
    body_max: int = fixed.BODY_MAX


@dataclass(frozen=True)
class Params:
    """``prompt_reviews`` and ``page_entries`` bound one row of a summary prompt
    or of a product page; a larger product gets more rows, never fewer reviews.
    ``prompt_chars``, if given, bounds a prompt by its length instead of its reviews."""

    target_languages: tuple[str, ...]
    passthrough_language: str = fixed.PASSTHROUGH_LANGUAGE
    quality: QualityParams = field(default_factory=QualityParams)
    summary_model: ModelParams = field(default_factory=ModelParams)
    judge_model: ModelParams = field(default_factory=ModelParams)
    rules: ReviewRules = field(default_factory=ReviewRules)
    engine: str = "external"
    prompt_reviews: int = 1000
    page_entries: int = 1000
    prompt_chars: int | None = None

    def __post_init__(self):
        # A language named twice would be the same map key twice.
        object.__setattr__(self, "target_languages", tuple(dict.fromkeys(self.target_languages)))
        _require(bool(self.target_languages), "target_languages must not be empty")
        unknown = sorted(set(self.target_languages) - set(fixed.LANGUAGES))
        _require(not unknown, f"unsupported target languages: {unknown}")
        _require(
            self.passthrough_language in fixed.LANGUAGES,
            f"unsupported passthrough_language: {self.passthrough_language}",
        )
        _require(
            self.passthrough_language not in self.target_languages,
            f"passthrough_language {self.passthrough_language} is also a target",
        )
        _require(self.prompt_reviews > 1, "prompt_reviews must be at least 2")
        _require(
            self.prompt_chars is None or self.prompt_chars >= fixed.PROMPT_CHARS_MIN,
            f"prompt_chars must be null or at least {fixed.PROMPT_CHARS_MIN}",
        )
        _require(self.page_entries > 0, "page_entries must be positive")

    @classmethod
    def from_dict(cls, raw: dict) -> Params:
        """Parameters from a parsed JSON settings object."""
        try:
            targets, models = raw["target_languages"], raw["models"]
            summary, judge = models["summarization"], models["quality_scoring"]
            return cls(
                target_languages=tuple(targets),
                passthrough_language=raw.get("passthrough_language", fixed.PASSTHROUGH_LANGUAGE),
                quality=QualityParams(**raw.get("quality", {})),
                summary_model=ModelParams(**summary),
                judge_model=ModelParams(**judge),
            )
        except KeyError as missing:
            raise ParamError(f"missing setting: {missing.args[0]}") from missing
        except TypeError as wrong:
            raise ParamError(f"unusable setting: {wrong}") from wrong
