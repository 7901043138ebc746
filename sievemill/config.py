"""Settings of the curation pipeline: one frozen dataclass, read from YAML on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Any


@dataclass(frozen=True)
class Validation:
    min_question_chars: int = 5
    max_question_chars: int = 500
    min_answer_chars: int = 20
    max_answer_chars: int = 2000
    similarity_threshold: float = 0.95
    semantic_sample_rate: float = 0.10


@dataclass(frozen=True)
class Generation:
    temperature_questions: float = 0.8
    temperature_answers: float = 0.3
    max_tokens_questions: int = 1000
    max_tokens_answers: int = 500
    content_chars: int = 8000


@dataclass(frozen=True)
class Service:
    model: str = "offline"
    max_retries: int = 3
    retry_delay_seconds: float = 5.0
    batch_check_interval_seconds: float = 30.0
    max_wait_hours: float = 24.0


@dataclass(frozen=True)
class Scraping:
    base_url: str = "https://help.example.com/en/"
    site_name: str = "Help Center"
    request_delay_seconds: float = 1.0
    max_retries: int = 3
    timeout_seconds: float = 30.0
    user_agent: str = "sievemill/1.0"
    collection_names: dict[str, str] = field(default_factory=dict)

    @property
    def origin(self) -> str:
        return "/".join(self.base_url.split("/")[:3])


@dataclass(frozen=True)
class Finetuning:
    base_model: str = "offline"
    suffix: str = "support"
    hyperparameters: dict[str, Any] = field(default_factory=lambda: {"n_epochs": "auto", "batch_size": "auto"})
    poll_interval_seconds: float = 30.0

    def explicit_hyperparameters(self) -> dict[str, Any]:
        """Those that are set to something else than 'auto'."""
        return {k: v for k, v in self.hyperparameters.items() if v != "auto"}


@dataclass(frozen=True)
class Config:
    validation: Validation = Validation()
    generation: Generation = Generation()
    service: Service = Service()
    scraping: Scraping = Scraping()
    finetuning: Finetuning = Finetuning()
    system_prompts: dict[str, str] = field(
        default_factory=lambda: {
            "default": "You are a support agent. Answer accurately and briefly.",
            "seller": "You are a support agent for sellers. Answer accurately and briefly.",
            "buyer": "You are a support agent for buyers. Answer accurately and briefly.",
        }
    )
    collection_prompt_mapping: dict[str, str] = field(default_factory=lambda: {"en": "seller", "de": "buyer", "fr": "missing"})


def from_dict(raw: dict[str, Any]) -> Config:
    """Known keys of a nested map; the others, and null sections, are ignored. The section `openai` is read as `service`."""
    raw = dict(raw)
    if "openai" in raw and "service" not in raw:
        raw["service"] = raw.pop("openai")
    parts: dict[str, Any] = {}
    for f in fields(Config):
        value = raw.get(f.name)
        if value is None:
            continue
        kind = {"validation": Validation, "generation": Generation, "service": Service, "scraping": Scraping, "finetuning": Finetuning}.get(f.name)
        if kind:
            known = {x.name for x in fields(kind)}
            parts[f.name] = kind(**{k: v for k, v in value.items() if k in known})
        else:
            parts[f.name] = dict(value)
    return Config(**parts)


def load(path: str) -> Config:
    """Settings of a YAML file; of a section that is given twice the last counts."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return from_dict(yaml.safe_load(f) or {})
