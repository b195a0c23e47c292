"""Operator 12: fill-in-middle transformation.

A text is cut into units, a word with the white space before it, and two of the places between units are drawn from a hash of the
row's key. Python sees a text once and returns two byte positions; Spark cuts the text there and puts the parts in their new order.

Units are found in the UTF-8 bytes, eight of them to a 64-bit word: sums that do not carry mark the bytes that end a unit, set bits
are counted by word, and the k-th unit's end is a search in the running counts and a selection inside one word. All texts of a batch
are one row of words; where one text ends, a unit ends too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import textnum as tn
from millrace.llm.common import small_batches

#: The marks of the three parts. A text that holds one of them is left as it is.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_ONES = np.uint64(0x0101010101010101)
_HIGH, _LOW = _ONES * np.uint64(0x80), _ONES * np.uint64(0x7F)
_BYTE, _TOP = np.uint64(8), np.uint64(56)


def _white(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is 0x20 or 0x09 to 0x0D; no sum of seven bits carries into the next byte."""
    low = words & _LOW
    blank = ~((low ^ (_ONES * np.uint64(0x20))) + _LOW)
    control = (low + _ONES * np.uint64(0x80 - 0x09)) & ~(low + _ONES * np.uint64(0x80 - 0x0E))
    return (blank | control) & ~words & _HIGH


class UnitEnds:
    """Where the units of many texts end; ``data`` and ``offs`` are their bytes and the places where they begin."""

    def __init__(self, data: np.ndarray, offs: np.ndarray) -> None:
        padded = np.full((len(data) // 8 + 1) * 8, 0x20, dtype=np.uint8)
        padded[: len(data)] = data
        white = _white(padded.view("<u8"))
        following = white >> _BYTE
        following[:-1] |= white[1:] << _TOP
        self.marks = ~white & _HIGH & following
        last = offs[1:][offs[1:] > offs[:-1]] - 1
        np.bitwise_or.at(self.marks, last >> 3, np.uint64(0x80) << ((last & 7) * 8).astype(np.uint64))
        self.upto = np.zeros(len(self.marks) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.marks), out=self.upto[1:])

    def before(self, at: np.ndarray) -> np.ndarray:
        """How many units end before the byte at each place."""
        word, inside = at >> 3, ((at & 7) * 8).astype(np.uint64)
        return self.upto[word] + np.bitwise_count(self.marks[word] & ((np.uint64(1) << inside) - np.uint64(1)))

    def after(self, k: np.ndarray) -> np.ndarray:
        """The place behind the end of the k-th unit of all, from 1."""
        word = np.searchsorted(self.upto, k, "left") - 1
        rank = (k - self.upto[word]).astype(np.uint64)
        running = (self.marks[word] >> np.uint64(7)) * _ONES  # byte i: how many of bytes 0 to i are marked
        reached = ((running | _HIGH) - rank * _ONES) & _HIGH
        return word * 8 + 9 - np.bitwise_count(reached)


def cut_places(texts: pa.Array, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n, head and tail of each text: its units, and the bytes before and up to the end of its middle part.

    The parts' borders are the smaller and the larger of ``first`` % (n + 1) and ``second`` % (n + 1), counted in units.
    """
    data, offs = tn.buffers(texts)
    ends = UnitEnds(data, offs)
    seen = ends.before(offs)
    n = np.diff(seen)
    a, b = first % (n + 1), second % (n + 1)
    places = []
    for k in (np.minimum(a, b), np.maximum(a, b)):
        at = np.zeros(len(n), dtype=np.int64)
        some = k > 0
        at[some] = ends.after(seen[:-1][some] + k[some]) - offs[:-1][some]
        places.append(at)
    return n, places[0], places[1]


def _cuts(text: Column, first: Column, second: Column) -> Column:
    @F.arrow_udf("n long, head long, tail long")
    def places(text: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        a, b = first.to_numpy(zero_copy_only=False), second.to_numpy(zero_copy_only=False)
        found = [cut_places(text.slice(i, j - i), a[i:j], b[i:j]) for i, j in tn.slices(text, 1 << 22)]
        columns = [np.concatenate([f[c] for f in found] or [np.zeros(0, np.int64)]) for c in range(3)]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["n", "head", "tail"])

    return places(text, first, second)


def transform(df: DataFrame, *, key: str = "doc_id", text: str = "text", seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """doc_id, text, n, form, prefix, middle, suffix, output of each row; the three parts are null where the form is plain.

    A text keeps its order ("plain") if it is empty, holds one of the marks or is not among the ``percent`` that are drawn; of the others
    ``spm_percent`` put the suffix first ("spm") and the rest the prefix ("psm"). Draws depend on ``seed`` and key alone, so repeated
    rows are cut alike; a null key draws like an empty one, a null text is an empty one. White space alone is one unit, and a part may
    be empty. Texts are never cut inside a character. An empty table stays empty and other columns are ignored.
    """
    small_batches(df.sparkSession)
    rows = df.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    rows = rows.select("*", _cuts(F.col("text"), draws[0], draws[1]).alias("cut"))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | marked | (draws[2] % 100 >= percent)
    form = F.when(plain, "plain").when(draws[3] % 100 < spm_percent, "spm").otherwise("psm")
    raw, head, tail = F.col("text").cast("binary"), F.col("cut.head").cast("int"), F.col("cut.tail").cast("int")

    def part(begin: Column, length: Column) -> Column:
        return F.when(F.col("form") != "plain", F.substring(raw, begin, length).cast("string"))

    rows = rows.withColumn("form", form).select(
        "doc_id", "text", F.col("cut.n").alias("n"), "form",
        part(F.lit(1), head).alias("prefix"), part(head + 1, tail - head).alias("middle"), part(tail + 1, F.octet_length("text") - tail).alias("suffix"),
    )
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    return rows.withColumn("output", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text")))


def restore(output: Column, form: Column) -> Column:
    """The text that transform() made ``output`` of. A part holds no mark, so each mark stands once; nulls stay null."""
    rest, middle = F.substring(output, len(PREFIX) + 1, 2**31 - 1), F.substring_index(output, MIDDLE, -1)
    sides = F.substring_index(rest, MIDDLE, 1)
    psm = F.concat(F.substring_index(sides, SUFFIX, 1), middle, F.substring_index(sides, SUFFIX, -1))
    spm = F.concat(F.substring_index(sides, PREFIX, -1), middle, F.substring_index(sides, PREFIX, 1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
