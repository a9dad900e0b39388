"""Fill-in-the-middle: a text is cut twice and its parts are put in another order, with markers.

The UTF-8 bytes of a batch of texts become one sequence of character classes, held in a wavelet
matrix: bytes that continue a character, white space and other characters, each at the start of
a line or a word or inside. Ranks of the classes add up to boundary counts of any unit
(characters, words, lines), and bisection on those counts finds the byte where the k-th unit
ends, for all texts of the batch at once and without decoding them.

A cut after 0 units is the start of the text, a cut after k the start of unit k + 1, a cut after
all the end. Words are runs other than space and ``\\x09-\\x0D``; white space stays with the word
before it. A line ends after its ``\\n``.

The cuts and the form follow a digest of ``<seed>:<doc_id>``, so reruns agree and rows that
repeat an id are cut alike (if equally long). Null texts count as empty; empty texts and texts
that hold a marker stay plain. A null id is written as nothing. Repeated rows give one row each;
extra columns are not read. Empty tables give an empty result. A batch is a few megabytes or one
text, so memory is a small multiple of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import exact_digest, small_batches
from tallyspark.llm.wavelet import WaveletMatrix

SEED = 1
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TRANSFORMED_PERCENT = 90
SPM_PERCENT = 20

# classes of a byte; the white and the other characters also tell whether a line or word starts
CONTINUED, WHITE, WHITE_LINE, INSIDE, WORD, WORD_LINE = range(6)
_BITS = 3
#: Units and the classes that start one.
UNITS = {
    "char": (WHITE, WHITE_LINE, INSIDE, WORD, WORD_LINE),
    "word": (WORD, WORD_LINE),
    "line": (WHITE_LINE, WORD_LINE),
}


def byte_classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of each byte; texts begin at ``starts``."""
    white = (data == 32) | ((data >= 9) & (data <= 13))
    fresh = np.zeros(len(data) + 1, bool)  # nothing of the same text comes before
    fresh[starts] = True
    line = fresh[:-1].copy()
    line[1:] |= data[:-1] == 10
    word = fresh[:-1].copy()
    word[1:] |= white[:-1]
    # a line that starts inside a word cannot be: the line feed before it is white
    out = np.where(white, np.where(line, WHITE_LINE, WHITE), np.where(line, WORD_LINE, np.where(word, WORD, INSIDE)))
    out[(data & 0xC0) == 0x80] = CONTINUED
    return out.astype(np.uint8)


def cut_points(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, unit: str = "char") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts ``data[offsets[i]:offsets[i + 1]]``, as arrays over the texts: the number of
    units; the bytes of both cuts, which follow as many units as the draws modulo one more than
    that number say, the smaller first; the characters before both cuts."""
    starts, ends = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    matrix = WaveletMatrix(byte_classes(data, starts), _BITS)
    symbols = UNITS[unit]
    before = matrix.count(symbols, starts)
    units = matrix.count(symbols, ends) - before
    wanted = np.sort(draws % (units + 1), axis=0)
    at = [np.where(k == 0, starts, matrix.last_with(symbols, before + k, starts, ends)) for k in wanted]
    first = matrix.count(UNITS["char"], starts)
    return units, np.stack(at), np.stack([matrix.count(UNITS["char"], p) - first for p in at])


def _draw(digest: Column, group: int) -> Column:
    """The ``group``-th eight hexadecimal digits as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array without nulls, and the offsets of its values in them."""
    wide = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cutter(unit: str):
    if unit not in UNITS:
        raise ValueError(f"unknown unit {unit!r}: one of {', '.join(UNITS)}")
    first, last, between = (m.encode() for m in (PREFIX, SUFFIX, MIDDLE))

    def arranged(text: bytes, start: int, end: int, form: str) -> bytes:
        before, middle, after = text[:start], text[start:end], text[end:]
        if form == "psm":
            return first + before + last + after + between + middle
        return last + after + first + before + between + middle

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            if not batch.num_rows:
                continue
            data, offsets = _bytes_of(batch.column(1))
            draws = np.stack([batch.column(c).to_numpy() for c in (2, 3)])
            forms = batch.column(4).to_pylist()
            units, at, chars = cut_points(data, offsets, draws, unit)
            whole = data.tobytes()
            outputs, spans = [], offsets.tolist()
            for i, (form, start, end) in enumerate(zip(forms, at[0].tolist(), at[1].tolist(), strict=True)):
                text, begin = whole[spans[i] : spans[i + 1]], spans[i]
                outputs.append(text if form == "plain" else arranged(text, start - begin, end - begin, form))
            plain = np.array([form == "plain" for form in forms], bool)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(units, pa.int64()),
                    batch.column(4),
                    pa.array(outputs, pa.binary()),
                    pa.array(chars[0], pa.int64(), mask=plain),
                    pa.array(chars[1] - chars[0], pa.int64(), mask=plain),
                ],
                names=["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"],
            )

    return cut


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "char",
    seed: int = SEED,
    transformed_percent: int = TRANSFORMED_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """``doc_id, n, form, output, prefix_chars, middle_chars``: number of units, form (``plain``,
    ``psm`` or ``spm``), the transformed text and the lengths in characters (null if plain)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.sha2(key.cast("binary"), 256).alias("digest"),
    )
    h1, h2, h3, h4 = (_draw(F.col("digest"), group) for group in range(4))
    plain = (F.col("text") == "") | (h3 % 100 >= transformed_percent)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains("text", F.lit(marker))
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    drawn = rows.select("doc_id", F.col("text").cast("binary").alias("text"), h1.alias("h1"), h2.alias("h2"), form.alias("form"))
    kind = drawn.schema["doc_id"].dataType.simpleString()
    parts = drawn.mapInArrow(_cutter(unit), f"doc_id {kind}, n long, form string, output binary, prefix_chars long, middle_chars long")
    return parts.withColumn("output", F.col("output").cast("string"))


def restore(output: Column, form: Column) -> Column:
    """The text a transformed one was made from. Its parts hold no marker and two markers cannot
    overlap, so each marker is found where it was written."""

    def between(left: str, right: str) -> Column:
        return F.substring_index(F.substring_index(output, right, 1), left, -1)

    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``transform`` by characters with its output and the text rebuilt from it as digests."""
    done = transform(docs, id_col, text_col)
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        exact_digest(F.col("output")).alias("output_sha256"),
        exact_digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
