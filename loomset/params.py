"""Job parameters. Unknown keys are rejected so that a typo cannot pass as a default."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

from loomset.errors import ConfigError
from loomset.functions.chat import TEMPLATES, ChatTemplate
from loomset.operators.rouge import METRICS
from loomset.sources.writer import COMPRESSIONS

# The defaults of the jobs.
SYSTEM_PROMPT = (
    "You are a helpful, precise assistant. Answer the user's instruction "
    "using the provided context when available."
)
# Sections of a configuration file that belong to the model trainer and are passed over.
TRAINER_SECTIONS = frozenset({"model", "quantization", "lora", "training"})


def _known(cls: type, section: str, given: Mapping[str, Any]) -> dict[str, Any]:
    unknown = sorted(set(given) - {f.name for f in fields(cls)})
    if unknown:
        raise ConfigError(f"Unknown key(s) in section '{section}': {', '.join(unknown)}")
    return dict(given)


@dataclass(frozen=True)
class DatasetParams:
    """Parameters of the prepare and training-text jobs."""

    name_or_path: str
    processed_dir: str
    raw_dir: str | None = None  # accepted for the sake of existing files, not used
    train_split: float = 0.8
    val_split: float = 0.1
    test_split: float = 0.1
    seed: int = 42
    min_examples: int = 1000
    max_seq_length: int = 2048
    text_field: str = "text"
    system_prompt: str = SYSTEM_PROMPT
    # Name of a chat layout; None is the generic ChatML one.
    template: str | None = None
    # Column that identifies a row; None derives the key from the content.
    key: str | None = None
    # Columns of a JSON source as DDL ("row_id long, instruction string"); None infers all of them.
    schema: str | None = None
    # False saves only key, text, prompt and target.
    keep_source: bool = True
    # Form of the splits: "json" is JSON Lines; of "parquet", a job reads only the columns it needs.
    file_format: str = "json"
    # None is Spark's own choice. Lines under gzip or deflate cannot be split between tasks.
    compression: str | None = None

    def __post_init__(self) -> None:
        shares = (self.train_split, self.val_split, self.test_split)
        if min(shares) < 0 or round(sum(shares), 9) != 1:
            raise ConfigError(f"Split shares must be positive and sum to 1, not {shares}")
        if self.template is not None and self.template not in TEMPLATES:
            raise ConfigError(f"Unknown template '{self.template}'; known: {sorted(TEMPLATES)}")
        if self.file_format not in COMPRESSIONS:
            raise ConfigError(f"Unknown file_format '{self.file_format}'; known: {sorted(COMPRESSIONS)}")
        known = COMPRESSIONS[self.file_format]
        if self.compression is not None and self.compression not in known:
            raise ConfigError(f"Unknown compression '{self.compression}'; known: {known}")

    @property
    def chat_template(self) -> ChatTemplate | None:
        return TEMPLATES[self.template] if self.template else None

    @property
    def planned(self) -> dict[str, float]:
        return {
            "train": self.train_split,
            "validation": self.val_split,
            "test": self.test_split,
        }


@dataclass(frozen=True)
class EvaluationParams:
    """Parameters of the evaluate job."""

    results_dir: str
    report_path: str | None = None
    # JSON Lines file of the test split, or a directory of finished splits; None means the dataset's
    # processed_dir.
    test_file: str | None = None
    max_new_tokens: int = 128
    num_qualitative_examples: int = 5
    metrics: tuple[str, ...] = METRICS
    partitions: int | None = None
    # Prompts are run in so many parts, each stored when it is done; a rerun goes on after them.
    buckets: int = 4
    # Bootstrap resamples behind the intervals of the scores; 0 leaves them out.
    resamples: int = 200
    # Version of a model's generator, to run it again when its code has changed.
    versions: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.buckets < 1 or self.resamples < 0:
            raise ConfigError("buckets must be at least 1 and resamples at least 0")
        wanted: list[str] = []
        for name in self.metrics:
            wanted += METRICS if name == "rouge" else (name,)
        unknown = sorted(set(wanted) - set(METRICS))
        if unknown or not wanted:
            raise ConfigError(f"Unknown or no metrics: {unknown}; known: rouge, {list(METRICS)}")
        object.__setattr__(self, "metrics", tuple(dict.fromkeys(wanted)))


@dataclass(frozen=True)
class JobParams:
    dataset: DatasetParams
    evaluation: EvaluationParams | None = None
    ignored: tuple[str, ...] = field(default=())

    @classmethod
    def from_mapping(cls, config: Mapping[str, Any]) -> JobParams:
        """Build from the sections ``dataset`` and ``evaluation``; trainer sections are ignored."""
        unknown = sorted(set(config) - {"dataset", "evaluation"} - TRAINER_SECTIONS)
        if unknown:
            raise ConfigError(f"Unknown section(s): {', '.join(unknown)}")
        if "dataset" not in config:
            raise ConfigError("Section 'dataset' is required")
        dataset = DatasetParams(**_known(DatasetParams, "dataset", config["dataset"]))
        evaluation = None
        if "evaluation" in config:
            evaluation = EvaluationParams(
                **_known(EvaluationParams, "evaluation", config["evaluation"])
            )
        return cls(dataset, evaluation, tuple(sorted(set(config) & TRAINER_SECTIONS)))

    @classmethod
    def from_file(cls, path: str) -> JobParams:
        """Read a JSON file, or a YAML file where PyYAML is installed."""
        with open(path, encoding="utf-8") as file:
            if path.endswith(".json"):
                return cls.from_mapping(json.load(file))
            try:
                import yaml
            except ImportError as error:
                raise ConfigError("PyYAML is not installed; use a .json file") from error
            return cls.from_mapping(yaml.safe_load(file))
