"""Arrow batches and tokenizer files for the operators of this package."""

from __future__ import annotations

from pathlib import Path

from inkwell.operators.arrow import map_columns

__all__ = ["map_columns", "tokenizer_path"]


def tokenizer_path(name: str, folder: str = "/opt/tokenizers") -> str:
    """Where the vocabulary file ``name`` of the public tokenizers lies, alike on the driver and the executors."""
    return str(Path(folder) / name)
