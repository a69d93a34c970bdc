"""Thresholds and toggles handed to the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

# Default thresholds.


@dataclass(frozen=True)
class CandidateRules:
    min_changed_files: int = 2
    max_changed_files: int = 30
    min_diff_lines: int = 50
    max_diff_lines: int = 2000
    min_issue_comments: int = 2
    min_reviews: int = 1
    min_review_comments: int = 2


@dataclass(frozen=True)
class GateRules:
    min_discussion_comments: int = 2
    min_review_comments: int = 2
    min_meaningful_review_comments: int = 2
    min_changed_files: int = 2
    max_changed_files: int = 30
    min_diff_lines: int = 50
    max_diff_lines: int = 2000
    require_source_patch: bool = True
    store_full_diff: bool = True
    exclude_bots: bool = True
    exclude_docs_only: bool = True
    exclude_lockfile_only: bool = True
    exclude_generated_vendor_only: bool = True
    exclude_trivial_review_comments: bool = True
    min_score: int = 70


@dataclass(frozen=True)
class AuditRules:
    accepted_size: int = 150
    rejected_size: int = 50
    borderline_size: int = 50
    borderline_low: int = 60
    borderline_high: int = 80
    seed: int = 42


@dataclass(frozen=True)
class SplitRules:
    train_ratio: float = 0.8
    val_ratio: float = 0.1
    seed: int = 42


@dataclass(frozen=True)
class ModelRules:
    token_cap: int = 1000
    embedding_width: int = 768
    trees: int = 250
    depth: int = 3
    step: float = 0.05
    row_share: float = 0.85
    column_share: float = 0.85
    leaf_penalty: float = 2.0
    least_hessian: float = 1.0
    bins: int = 64
    seed: int = 42


@dataclass(frozen=True)
class Settings:
    candidates: CandidateRules = field(default_factory=CandidateRules)
    gate: GateRules = field(default_factory=GateRules)
    audit: AuditRules = field(default_factory=AuditRules)
    split: SplitRules = field(default_factory=SplitRules)
    model: ModelRules = field(default_factory=ModelRules)


DEFAULTS = Settings()
