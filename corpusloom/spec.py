"""Source descriptors: what a source is called, where it lies, how its rows become text."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, fields

# Shared defaults of the data model.
MIN_CHARS = 10
MIN_TOKENS_BATCH = 32
MIN_TOKENS_LAZY = 10
MAX_SEQ_LENGTH = 2048
DEFAULT_BATCH_CAP = 100_000
SEED = 42
TEST_SHARE = 0.01


class SourceError(ValueError):
    """A source that cannot be used as its spec says; a tolerant run leaves it out."""


class _Unset:
    """Marks a cap that was not given; each load path has its own default."""

    def __repr__(self) -> str:
        return "UNSET"


UNSET = _Unset()


@dataclass(frozen=True)
class SourceSpec:
    """One entry of the source catalog.

    ``key_columns`` name the typed columns that identify a row. They give the
    order in which a cap counts rows and the ``row_key`` that keeps shuffles and
    splits stable. Leave them empty for tables without a key: rows are then
    keyed by content.
    """

    name: str
    config: str | None = None
    split: str = "train"
    text_field: str = "text"
    answer_field: str | None = None
    system_field: str | None = None
    format: str = "text"
    weight: float = 0.0
    streaming: bool = False
    max_samples: object = UNSET
    category: str = "text"
    key_columns: tuple[str, ...] = ()
    path: str | None = None
    reader: str = "parquet"
    reader_options: Mapping[str, str] = field(default_factory=dict, hash=False)
    subset_column: str | None = None
    split_column: str | None = None

    def __post_init__(self) -> None:
        if not self.name or "|" in self.name:
            raise ValueError(f"source name must be non-empty and free of '|': {self.name!r}")
        if not self.text_field:
            raise ValueError(f"{self.name}: text_field is required")
        if not isinstance(self.streaming, bool):
            raise ValueError(f"{self.name}: streaming must be a bool")
        if self.weight < 0:
            raise ValueError(f"{self.name}: weight must not be negative")
        cap = self.max_samples
        if cap is not UNSET and cap is not None and cap != math.inf:
            if isinstance(cap, bool) or not isinstance(cap, int) or cap < 0:
                raise ValueError(f"{self.name}: max_samples must be a whole number >= 0, got {cap!r}")
        object.__setattr__(self, "key_columns", tuple(self.key_columns))

    @classmethod
    def from_mapping(cls, entry: Mapping[str, object], **overrides: object) -> "SourceSpec":
        """Build a spec from a plain catalog dict; unknown keys are refused."""
        known = {f.name for f in fields(cls)}
        values = {**entry, **overrides}
        unknown = sorted(set(values) - known)
        if unknown:
            raise ValueError(f"unknown source keys: {unknown}")
        return cls(**values)

    def _cap(self, default: int | None) -> int | None:
        cap = default if self.max_samples is UNSET else self.max_samples
        return None if cap is None or cap == math.inf else int(cap)

    @property
    def batch_cap(self) -> int | None:
        """Cap of the table loader: 100,000 rows unless the spec says otherwise."""
        return self._cap(DEFAULT_BATCH_CAP)

    @property
    def stream_cap(self) -> int | None:
        """Cap of the streaming loader: none unless the spec gives one."""
        return self._cap(None)

    @property
    def is_reasoning(self) -> bool:
        return self.format == "reasoning" and bool(self.answer_field)


def check_catalog(specs: Iterable[SourceSpec]) -> list[SourceSpec]:
    """Return the specs as a list; source names must be unique."""
    specs = list(specs)
    names = [s.name for s in specs]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"source names must be unique: {repeated}")
    return specs


# The public datasets of the default mix, their columns, weights and caps.
# name, config, split, text, answer, system, format, weight, lazy, cap, category
_DEFAULT_SOURCES = (
    ("HuggingFaceFW/fineweb-edu", "sample-10BT", "train", "text", None, None, "text", 0.20, True, 500_000, "text"),
    ("uonlp/CulturaX", "de", "train", "text", None, None, "text", 0.10, True, 300_000, "text"),
    ("bigcode/the-stack-dedup", "data/python", "train", "content", None, None, "text", 0.10, True, 300_000, "code"),
    ("openai/gsm8k", "main", "train", "question", "answer", None, "reasoning", 0.08, False, 50_000, "reasoning"),
    ("meta-math/MetaMathQA", None, "train", "query", "response", None, "reasoning", 0.10, True, 300_000, "reasoning"),
    ("Open-Orca/OpenOrca", None, "train", "question", "response", "system_prompt", "reasoning", 0.12, True, 400_000,
     "reasoning"),
    ("garage-bAInd/Open-Platypus", None, "train", "instruction", "output", None, "reasoning", 0.08, False, 50_000,
     "reasoning"),
    ("microsoft/orca-math-word-problems-200k", None, "train", "question", "answer", None, "reasoning", 0.07, False,
     200_000, "reasoning"),
    ("HuggingFaceH4/ultrachat_200k", None, "train_sft", "messages", None, None, "text", 0.05, False, 100_000,
     "instructions"),
    ("LeoLM/OpenSchnabeltier", None, "train", "instruction", "output", None, "reasoning", 0.05, False, 50_000,
     "instructions"),
)

# Published share of each category in the default mix.
DECLARED_SHARES = {"text": 0.30, "code": 0.10, "reasoning": 0.50, "instructions": 0.10}


def default_catalog(root: str | None = None) -> list[SourceSpec]:
    """The default ten-source mix; with ``root``, each source is read from ``root/<name>``."""
    specs = []
    for name, config, split, text, answer, system, fmt, weight, lazy, cap, category in _DEFAULT_SOURCES:
        specs.append(
            SourceSpec(
                name=name,
                config=config,
                split=split,
                text_field=text,
                answer_field=answer,
                system_field=system,
                format=fmt,
                weight=weight,
                streaming=lazy,
                max_samples=cap,
                category=category,
                path=None if root is None else f"{root.rstrip('/')}/{name}",
                subset_column="config" if config else None,
                split_column="split",
            )
        )
    return check_catalog(specs)
