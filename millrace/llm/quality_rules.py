"""Operator 1: quality rules with tokeniser fertility.

Two public vocabularies measure every text: characters per token and token entropy by a byte-level BPE for
many languages, the share of byte-fallback pieces by a SentencePiece model. Words are encoded one by one,
with a blank before them, so that each distinct word is encoded once and its counts are reused. Texts
outside their language's bands (or their script's, for other languages) are rejected.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import textnum as tn
from millrace.llm import vocabulary
from millrace.llm.common import of_worker, small_batches


@dataclass(frozen=True)
class Band:
    """What a text must keep to: characters per token, byte-fallback share, and bits of token entropy.

    A short text cannot reach a high entropy: the least one is ``entropy`` or ``entropy_share`` of the
    logarithm of its number of tokens, whichever is less.
    """

    least_chars: float
    most_chars: float
    byte_share: float
    entropy: float
    entropy_share: float


#: By language, then by script ("latin", "other") for languages without a band of their own.
BANDS: dict[str, Band] = {
    "en": Band(1.85, 6.0, 0.05, 3.5, 0.5),
    "de": Band(1.85, 6.0, 0.05, 3.5, 0.5),
    "fr": Band(1.70, 6.0, 0.05, 3.5, 0.5),
    "es": Band(1.80, 6.0, 0.05, 3.5, 0.5),
    "latin": Band(1.2, 8.0, 0.20, 3.0, 0.45),
    "other": Band(0.3, 8.0, 0.80, 3.0, 0.4),
}

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_pieces", "n_byte_pieces")
_TYPE = "struct<" + ", ".join(f"{c}: long" for c in _COUNTS) + ", token_entropy: double, script: string>"
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_WINDOW = 8


class _Fertility:
    """Tokens of distinct words under both vocabularies; it starts anew beyond ``limit`` words, so its memory is bounded."""

    def __init__(self, bpe_path: str, piece_path: str, limit: int = 120_000) -> None:
        self.bpe, self.model, self.limit = vocabulary.byte_bpe(bpe_path), vocabulary.piece_model(piece_path), limit
        self.is_byte = np.zeros(self.model.get_piece_size(), dtype=np.int64)
        self.is_byte[list(vocabulary.byte_pieces(piece_path))] = 1
        self.forget()

    def forget(self) -> None:
        self.index: dict[int, int] = {}
        self.tokens, self.sizes = array("I"), array("q")
        self.pieces, self.byte_pieces = array("q"), array("q")

    def of(self, hashes: np.ndarray, texts: Callable[[np.ndarray], list[str]]) -> np.ndarray:
        """Numbers of words by hash; ``texts`` gives the texts of the chosen ones where they are new."""
        if len(self.index) > self.limit:
            self.forget()
        found = np.fromiter(map(self.index.get, hashes.tolist(), repeat(-1)), np.int64, len(hashes))
        new = np.flatnonzero(found < 0)
        if len(new):
            strings, encode = texts(new), self.bpe.encode_ordinary
            tokens = [encode(" " + s) for s in strings]
            self.tokens.extend(chain.from_iterable(tokens))
            self.sizes.extend(map(len, tokens))
            pieces = self.model.encode(strings, num_threads=1)
            sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
            flat = np.fromiter(chain.from_iterable(pieces), np.int64, int(sizes.sum()))
            self.pieces.frombytes(sizes.tobytes())
            self.byte_pieces.frombytes(np.add.reduceat(self.is_byte[flat], np.cumsum(sizes) - sizes).tobytes())
            found[new] = np.arange(len(self.index), len(self.index) + len(new))
            self.index.update(zip(hashes[new].tolist(), found[new].tolist()))
        return found


def _measure(data: np.ndarray, offs: np.ndarray, fertility: _Fertility) -> dict[str, np.ndarray]:
    n = len(offs) - 1
    out = {c: np.zeros(n, dtype=np.int64) for c in _COUNTS} | {"token_entropy": np.zeros(n), "latin": np.ones(n, dtype=bool)}
    if not len(data):
        return out
    start, end, doc = tn.words(data, offs)
    out["n_words"] = np.bincount(doc, minlength=n)
    lead = (data & 0xC0) != 0x80
    covered = np.zeros(len(data) + 1, dtype=np.int8)
    covered[start] += 1
    covered[end] -= 1  # no two words end at one place
    in_word = np.cumsum(covered[:-1], dtype=np.int8).astype(bool)
    out["word_chars"] = tn.per_document(lead & in_word, offs)
    out["n_symbols"] = tn.per_document(_SYMBOL[data], offs)
    # code points up to U+024F begin with a byte below 0xCA
    out["latin"] = 2 * tn.per_document(lead & (data < 0xCA), offs) >= tn.per_document(lead, offs)
    prefix = tn.prefix_hash(data, tn.BASE)
    # lines, without the break: those with a word that equal an earlier one of the same document
    breaks = np.flatnonzero(data == 0x0A)
    line_start = np.union1d(offs[:-1][offs[1:] > offs[:-1]], breaks + 1)
    line_start = line_start[line_start < len(data)]
    line_doc = np.searchsorted(offs, line_start, "right") - 1
    line_end = np.minimum(np.append(line_start[1:], len(data)), offs[line_doc + 1])
    line_end = np.where((line_end > line_start) & (data[np.maximum(line_end, 1) - 1] == 0x0A), line_end - 1, line_end)
    has_word = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end, line_doc = line_start[has_word], line_end[has_word], line_doc[has_word]
    _, later = tn.repeated(tn.mix(tn.span_hash(prefix, tn.BASE, line_start, line_end) ^ tn.mix(line_doc.astype(np.uint64))))
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=n)
    if not len(start):
        return out
    # words in 8-word windows that are found twice or more
    word = tn.span_hash(prefix, tn.BASE, start, end)
    if len(word) >= _WINDOW:
        whole = np.flatnonzero(doc[_WINDOW - 1 :] == doc[: 1 - _WINDOW])
        over = tn.prefix_hash(word, tn.BASE2)
        twice, _ = tn.repeated(tn.mix(tn.span_hash(over, tn.BASE2, whole, whole + _WINDOW) ^ tn.mix(doc[whole].astype(np.uint64))))
        edge = np.zeros(len(word) + 1, dtype=np.int64)
        edge[whole[twice]] += 1
        edge[whole[twice] + _WINDOW] -= 1
        out["n_repeat_words"] = np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=n)
    # fertility, over distinct words
    distinct, first, which = np.unique(word, return_index=True, return_inverse=True)
    raw = data.tobytes()
    texts = lambda new: [raw[i:j].decode("utf-8", "replace") for i, j in zip(start[first[new]].tolist(), end[first[new]].tolist())]
    at = fertility.of(distinct, texts)
    out["n_pieces"] = np.bincount(doc, np.array(fertility.pieces)[at][which], minlength=n).astype(np.int64)
    out["n_byte_pieces"] = np.bincount(doc, np.array(fertility.byte_pieces)[at][which], minlength=n).astype(np.int64)
    every = np.array(fertility.sizes)
    begins, sizes, flat = (np.cumsum(every) - every)[at], every[at], np.array(fertility.tokens).astype(np.int64)
    lengths = sizes[which]
    ends = np.cumsum(lengths)
    position = np.arange(ends[-1]) - np.repeat(ends - lengths - begins[which], lengths)
    pairs, count = np.unique((np.repeat(doc, lengths) << 20) | flat[position], return_counts=True)
    total = np.bincount(doc, lengths, minlength=n)
    out["n_tokens"] = total.astype(np.int64)
    share = count / total[pairs >> 20]
    out["token_entropy"] = np.bincount(pairs >> 20, -share * np.log2(share), minlength=n)
    return out


def _measures(bpe_path: str, piece_path: str):
    @F.arrow_udf(_TYPE)
    def measure(text: pa.Array) -> pa.Array:
        fertility = of_worker(f"fertility {bpe_path} {piece_path}", lambda: _Fertility(bpe_path, piece_path))
        parts = [_measure(*tn.buffers(text.slice(i, j - i)), fertility) for i, j in tn.slices(text)]
        cols = [pa.array(np.concatenate([p[c] for p in parts]) if parts else [], pa.int64()) for c in _COUNTS]
        cols.append(pa.array(np.concatenate([p["token_entropy"] for p in parts]) if parts else [], pa.float64()))
        latin = np.concatenate([p["latin"] for p in parts]) if parts else np.zeros(0, bool)
        cols.append(pa.array(np.where(latin, "latin", "other"), pa.string()) if len(latin) else pa.array([], pa.string()))
        return pa.StructArray.from_arrays(cols, [*_COUNTS, "token_entropy", "script"])

    return measure


def measure(
    df: DataFrame,
    out: str = "quality",
    *,
    text: str = "text",
    lang: str = "lang",
    bands: Mapping[str, Band] = BANDS,
    least_words: int = 20,
    most_repeats: int = 30,
    bpe_path: str | None = None,
    piece_path: str | None = None,
) -> DataFrame:
    """``df`` with a struct column ``out``: the counts, chars_per_token, byte_share, token_entropy, base_failed, kept.

    All columns of ``df`` stay (one called ``out`` is replaced); rows are neither moved nor dropped. A null or
    empty text has no words and fails the base rules. A null or unknown language takes the band of the
    text's script: latin if half of its code points or more are below U+0250, else other. Repeated
    rows get equal results; an empty table stays empty.
    """
    small_batches(df.sparkSession)
    udf = _measures(bpe_path or vocabulary.default_path("byte_bpe_multi_50k.tiktoken"), piece_path or vocabulary.default_path("piece_bpe_32k.model"))
    m = F.col("_m")
    cpt = F.when(m["n_tokens"] > 0, m["word_chars"] / m["n_tokens"])
    share = F.when(m["n_pieces"] > 0, m["n_byte_pieces"] / m["n_pieces"])
    failed = (m["n_words"] < least_words) | (100 * m["n_repeat_words"] > most_repeats * m["n_words"])

    def within(b: Band) -> Column:
        floor = F.least(F.lit(float(b.entropy)), b.entropy_share * F.log2(F.greatest(m["n_tokens"], F.lit(1)).cast("double")))
        return (cpt >= b.least_chars) & (cpt <= b.most_chars) & (share <= b.byte_share) & (m["token_entropy"] >= floor)

    band = F.when(F.lit(False), F.lit(True))
    for name, b in bands.items():
        if name not in ("latin", "other"):
            band = band.when(F.col("_lang") == name, within(b))
    band = band.when(m["script"] == "latin", within(bands["latin"])).otherwise(within(bands["other"]))
    plain = [m[c].alias(c) for c in (*_COUNTS, "token_entropy", "script")]
    kept = ~failed & F.coalesce(band, F.lit(False))
    others = [c for c in df.columns if c != out]
    # the caller's columns travel in a struct, where their names cannot clash; the optimizer takes it apart again
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{lang}`").alias("_lang"), udf(F.col(f"`{text}`")).alias("_m"))
    measures = F.struct(*plain, cpt.alias("chars_per_token"), share.alias("byte_share"), failed.alias("base_failed"), kept.alias("kept"))
    return rows.select(*[F.col("_row")[c].alias(c) for c in others], measures.alias(out))


def keep(df: DataFrame, **options) -> DataFrame:
    """The rows that pass, with the columns of ``df`` alone. Options are those of measure()."""
    columns, name = df.columns, "_quality"
    while name in columns:
        name += "_"
    return measure(df, name, **options).where(F.col(name)["kept"]).select(*[F.col(f"`{c}`") for c in columns])
