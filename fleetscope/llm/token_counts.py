"""Token counts by overlap resynchronisation.

A text of up to ``CHUNK`` characters is encoded at once.  A longer one is encoded in
chunks that overlap; each chunk's pieces come with their places in the text.  Two
neighbours are spliced at a common boundary: a place in the overlap where both have a piece
boundary and which is proven stable, that is, where no piece of the vocabulary can
reach across.  If an overlap holds no such place it is widened, at last to the rest of
the text, which is the encoding as a whole.

Stable places: the vocabulary is read once.  If its word mark (U+2581) stands in no piece
behind another character, no merge crosses from a non-blank to a blank, so the pieces on
either side of such a place do not depend on each other.  A vocabulary without that property has no
proven place, and its texts are encoded whole.

Nulls: a null text has 0 bytes and 0 tokens, as an empty one.  Every row counts for itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import bounded_batches

CHUNK = 32_768      # characters encoded at once
OVERLAP = 256       # characters that neighbouring chunks share at first
LIMIT = 4096
MARK = "▁"
#: A blank behind a character that is neither a blank nor the mark.
_STABLE = re.compile(f"(?<=[^ {MARK}]) ")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(path: str):
    """The processor, and whether blanks behind non-blanks are proven boundaries."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    inner = any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(sp.get_piece_size()))
    # the normaliser must leave a blank a blank, with or without neighbours
    plain = sp.encode("a b", out_type=str) == [*sp.encode("a", out_type=str), *sp.encode("b", out_type=str)]
    return sp, plain and not inner


def _begins(sp, text: str, head: bool) -> list[int]:
    """Where the pieces of ``text`` begin, as character places, in order.

    Only the first chunk starts a text; the others start at a blank, for which stands
    the mark that the processor puts before a text.
    """
    at = [a for a, _ in sp.encode(text if head else text[1:], return_type="offset_mapping")["offsets"]]
    return at if head or not at else [0, *(a + 1 for a in at[1:])]


def count(text: str | None, sp, stable: bool, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text``, the same as ``len(sp.encode(text))``."""
    if not text:
        return 0
    if len(text) <= chunk or not stable:
        return len(sp.encode(text))
    total, start, head = 0, 0, True
    while True:
        width, splice = overlap, None
        while splice is None:
            end = min(len(text), start + chunk + width)
            begins = _begins(sp, text[start:end], head)
            if end == len(text):
                return total + len(begins)
            splice = _splice(sp, text, start, start + chunk, end, begins)
            width *= 2
        total += sum(b < splice - start for b in begins)
        start, head = splice, False


def _splice(sp, text: str, start: int, lo: int, end: int, begins: list[int]) -> int | None:
    """The first stable place from ``lo`` on from which the next chunk's pieces are the former chunk's
    as far as the overlap's last stable place; None if the overlap has no two such places."""
    places = [m.start() for m in _STABLE.finditer(text, lo, end)]
    if len(places) < 2:
        return None
    last = places[-1]
    own = {b + start for b in begins}
    for at in places[:-1]:
        if at in own and [b + at for b in _begins(sp, text[at:last], False)] == [b + start for b in begins if at <= b + start < last]:
            return at
    return None


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, stable = load(path)
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            short = [i for i, t in enumerate(texts) if t and len(t) <= CHUNK]
            n = [0] * len(texts)
            for i, ids in zip(short, sp.encode([texts[i] for i in short], num_threads=1), strict=True):
                n[i] = len(ids)
            for i, t in enumerate(texts):
                if t and len(t) > CHUNK:
                    n[i] = count(t, sp, stable)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], [*b.schema.names[:-1], "n_tokens"])
    return run


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``, without a shuffle."""
    bounded_batches(docs.sparkSession)
    path = path or model_path()
    base = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    kind = base.schema["doc_id"].dataType.simpleString()
    out = base.mapInArrow(_count(path), f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
