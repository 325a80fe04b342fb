"""Run settings. One frozen object is passed down; nothing reads globals."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Fixed default values: results are defined by these numbers.
    shard_size: int = 10_000
    max_docs: int = 0  # 0 keeps everything

    min_chars: int = 100
    max_chars: int = 1_000_000
    max_html_ratio: float = 0.1
    min_avg_line_len: int = 20

    min_lang_confidence: float = 0.8

    minhash_threshold: float = 0.85
    minhash_perms: int = 128
    shingle_size: int = 5

    max_lang_fraction: float = 0.3
    target_docs: int = 0  # 0 means cap mode
    random_seed: int = 42

    vocab_size: int = 32_000
    min_frequency: int = 2
    validation_docs: int = 0  # 0 validates on all documents

    # How many characters of a text each detector looks at; None: all of them.
    binary_window: int | None = None
    sniff_window: int | None = None
    lang_window: int | None = None
    domain_window: int | None = None

    run_id: str = "run_001"
