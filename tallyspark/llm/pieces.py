"""SentencePiece encoding and decoding through a table of distinct chunks.

When no piece of the vocabulary has a white space marker after another character, merges never
cross from a word into the marker before the next one. A text then falls apart into chunks,
each a run of markers and the characters up to the next marker, that are segmented
independently. Chunks repeat, so each distinct one is segmented once and the ids are joined
back by position:

1. every task counts the chunks of its rows; those seen at least ``MIN_COUNT`` times in a
   stretch of rows are summed over the corpus;
2. the most frequent ones, at most ``table_rows`` (chosen with a histogram of counts), are
   segmented once, spread over the cluster, and the table is broadcast: its size is bounded by
   that parameter, and chunks longer than ``MAX_CHUNK`` are not put in it;
3. every task looks its chunks up by position; a chunk outside the table is segmented where it
   is met and kept in the task's own bounded table.

The table only saves work: the result does not depend on what it holds. ``Chunks`` refuses a
vocabulary whose pieces cross markers. Null texts count as empty (no ids); rows, ids and order
of a document are never dropped; repeated rows give repeated results; only the id and text
columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyspark.llm.common import small_batches, stage

MARK = "▁"
MIN_COUNT = 8
TABLE_ROWS = 1 << 17
MAX_CHUNK = 64
_OWN_ROWS = 200_000
_SPLIT = re.compile("[ ▁]+[^ ▁]*")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def chunks_of(text: str | None) -> list[str]:
    """Chunks of one whole text, each without its first marker (which encoding adds)."""
    if not text:
        return []
    if MARK not in text and "  " not in text and text[0] != " ":
        return text.split(" ")
    return [c[1:] for c in _SPLIT.findall(" " + text)]


class Chunks:
    """Segments chunks with one model and remembers a bounded number of them.

    ``table`` maps a chunk to ``(number of ids, ids joined by commas, decoded text)``.
    """

    _loaded: dict = {}

    def __init__(self, model: str | None):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model or default_model())
        pieces = (self.model.id_to_piece(i) for i in range(self.model.vocab_size()))
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces of this model cross white space markers; encode whole texts instead")
        self.alone = self.model.piece_to_id(MARK)
        self.own: dict[str, tuple[int, str, str]] = {}

    @classmethod
    def load(cls, model: str | None) -> Chunks:
        """One instance per Python worker, kept from task to task."""
        if model not in cls._loaded:
            cls._loaded[model] = cls(model)
        return cls._loaded[model]

    def segment(self, chunks: list[str]) -> list[tuple[int, str, str]]:
        ids = self.model.encode(chunks, num_threads=1)
        texts = self.model.decode(ids) if chunks else []
        out = []
        for chunk, one, text in zip(chunks, ids, texts, strict=True):
            if not chunk:  # a marker alone: encoding an empty text gives nothing
                one, text = [self.alone], ""
            out.append((len(one), ",".join(map(str, one)), chunk if text == chunk else text))
        return out

    def look_up(self, words: set[str], table: dict) -> dict:
        """The entries of ``words``; new ones are segmented together and kept."""
        if len(self.own) > _OWN_ROWS:
            self.own = {}
        own = self.own
        new = [w for w in words if w not in table and w not in own]
        own.update(zip(new, self.segment(new), strict=True))
        return own


def _frequent_chunks(docs: DataFrame, text_col: str, min_count: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def often() -> pa.RecordBatch:
            kept = {c: n for c, n in seen.items() if n >= min_count and len(c) <= MAX_CHUNK}
            return pa.RecordBatch.from_arrays(
                [pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], ["chunk", "n"]
            )

        for batch in small_batches(batches):
            for text in batch.column(0).to_pylist():
                seen.update(chunks_of(text))
                if len(seen) > _OWN_ROWS:
                    yield often()
                    seen = Counter()
        yield often()

    return docs.select(text_col).mapInArrow(count, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))


def chunk_table(
    docs: DataFrame,
    text_col: str = "text",
    model: str | None = None,
    table_rows: int = TABLE_ROWS,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """``chunk, n_ids, ids, decoded`` of at most ``table_rows`` frequent chunks, each segmented once."""
    counts, _ = stage(_frequent_chunks(docs, text_col, min_count), "chunk-counts")
    step = F.floor(F.log2("n") * 8).cast("int")  # at most 512 steps
    fits, least = 0, None
    for s, n in sorted(counts.groupBy(step.alias("s")).count().collect(), reverse=True):
        fits += n
        if fits > table_rows:
            break
        least = s
    frequent = counts.where(step >= least) if least is not None else counts.limit(0)

    def segment(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = batch["chunk"].tolist()
            done = Chunks.load(model).segment(words)
            yield pd.DataFrame([(w, *d) for w, d in zip(words, done, strict=True)], columns=["chunk", "n_ids", "ids", "decoded"])

    return frequent.select("chunk").mapInPandas(segment, "chunk string, n_ids int, ids string, decoded string")


def _joined(docs: DataFrame, id_col: str, text_col: str, model, table_rows: int, finish, schema: str) -> DataFrame:
    """Apply ``finish(entries of a text in order)`` to every document."""
    rows = chunk_table(docs, text_col, model, table_rows).toPandas()  # bounded by table_rows
    table = docs.sparkSession.sparkContext.broadcast(
        {c: (n, ids, c if text == c else text) for c, n, ids, text in rows.itertuples(index=False)}
    )
    out_fields = T._parse_datatype_string(schema).fields
    types = [to_arrow_type(f.dataType) for f in out_fields]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tool = table.value, Chunks.load(model)
        for batch in small_batches(batches):
            texts = [chunks_of(text) for text in batch.column(1).to_pylist()]
            own = tool.look_up(set().union(*texts), known)  # one call: each call to the library has a cost
            out = [finish([known[w] if w in known else own[w] for w in words]) for words in texts]
            made = [pa.array([o[i] for o in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["doc_id", *[f.name for f in out_fields]])

    id_field = T.StructField("doc_id", docs.schema[id_col].dataType)
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(encode, T.StructType([id_field, *out_fields]))


def _digests(entries):
    ids = ",".join([e[1] for e in entries])
    text = " ".join([e[2] for e in entries])
    return (
        sum([e[0] for e in entries]),
        hashlib.sha256(ids.encode()).hexdigest(),
        hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
    )


def token_digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, table_rows: int = TABLE_ROWS
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    return _joined(
        docs, id_col, text_col, model, table_rows, _digests, "n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _ids(entries):
    return ([int(i) for e in entries for i in e[1].split(",")], " ".join([e[2] for e in entries]))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, table_rows: int = TABLE_ROWS) -> DataFrame:
    """``doc_id, ids, decoded``: the ids of every document and the text they decode to."""
    return _joined(docs, id_col, text_col, model, table_rows, _ids, "ids array<int>, decoded string")
