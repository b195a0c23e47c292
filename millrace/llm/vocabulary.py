"""Public tokenizers, loaded once in each Python worker and let go with the tables made of them. Their files stay where they are; paths are parameters."""

from __future__ import annotations

import base64
import functools
import json

import public_tokenizers

from millrace.llm.common import let_go_with_tables


@functools.lru_cache(maxsize=1)
def byte_bpe(path: str):
    """A byte-level BPE vocabulary in rank form."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def added_tokens(path: str) -> dict[str, int]:
    """Ids of the tokens that a tokenizer's json adds to its vocabulary; they are found in texts before all else."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    odd = [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if odd:
        raise ValueError(f"added tokens of {path} that do not match as they stand: {odd}")
    return {t["content"]: t["id"] for t in added}


@functools.cache
def piece_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@functools.cache
def byte_pieces(path: str) -> frozenset[int]:
    """Ids of the pieces that stand for single bytes."""
    model = piece_model(path)
    return frozenset(i for i in range(model.get_piece_size()) if model.is_byte(i))


let_go_with_tables(byte_bpe.cache_clear, piece_model.cache_clear)


def default_path(name: str) -> str:
    return public_tokenizers.path(name)
