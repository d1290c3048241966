"""Public tokenizers, loaded once per Python worker from files whose folder is a parameter."""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

TOKENIZERS = "/opt/tokenizers"


@lru_cache(maxsize=4)
def byte_bpe(folder: str):
    """Byte-level BPE with 50,256 ranks; ``encode_ordinary_batch`` never sees special tokens."""
    import base64
    import importlib.util

    import tiktoken

    spec = importlib.util.spec_from_file_location("_public_tokenizers", Path(folder) / "__init__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    with open(Path(folder) / "byte_bpe_50k.tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=module.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def piece_bpe(folder: str):
    """SentencePiece BPE with byte fallback, 32,000 pieces."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=str(Path(folder) / "piece_bpe_32k.model"))


@lru_cache(maxsize=4)
def piece_kinds(folder: str):
    """For each piece: whether it is a byte, as a numpy array."""
    import numpy as np

    sp = piece_bpe(folder)
    return np.fromiter((sp.is_byte(i) for i in range(sp.get_piece_size())), dtype=bool)
